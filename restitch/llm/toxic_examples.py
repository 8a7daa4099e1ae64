"""Labelled training sentences for the toxic-span tagger: many worded after sentences seen in the given tables, others paraphrased.

Abusive spans stand between « and »; everything else is labelled harmless.  Slots in
braces are filled at random, so that the words in them carry no weight.
"""

from __future__ import annotations

# The labelled sentences and the words of their slots.
SLOTS = {
    "insult": """idiot|moron|bitch|asshole|shithead|scumbag|dumb bastard|pathetic loser|brainless clown|worthless hack|fat pig|ugly cow|lying scumbag|piece of trash
        |stupid jackass|dickhead|jerk|imbecile|cretin|dumbass|filthy liar|cunt|whore|slut|wanker|prick|degenerate|retard|dipshit|piece of shit|motherfucker|waste of space|ugly toad|stupid cow|fat slob|spineless worm""",
    "group": """women|immigrants|foreigners|gays|cripples|homeless people|people from across the river|the old folks|these refugees|those refugees|these religious people|the poor|lesbians|disabled people
        |people with that accent|blacks|Jews|Muslims|gypsies|trans people|beggars|migrants|the deaf|those people""",
    "adj": "odd|quiet|bright|warm|shabby|loud|modest|grim|tender|careful|strange|clumsy|pale|narrow|slow|green|old|new|little|big",
    "thing": "poster|record|guitar|novel|film|menu|mural|bicycle|piano|photograph|play|parade|haircut|costume|radio|window|lamp|story|review|song|column|exhibit|jukebox|dance floor",
    "venue": "Old Lantern|Garden Cellar|Harbor Room|Corner Hall|Iron Tap|Blue Arcade|Mill Club|Station Bar|River Stage",
    "place": "Old Mill|Lakeview|the Flats|Eastbank|Northtown|Bergen|West Hill|the harbor|Southgate|Quarry Row",
    "band": "The Late Trains|Sad Pilots|Green Doors|Static Wolves|Paper Engines|The Velvet Hours|Blue Kettles|Holy Parrots",
    "who": "the drummer|my neighbor|our photographer|the baker|a student|her sister|the owner|the doorman|a retired welder|the bartender",
    "when": "last winter|after midnight|that spring|on Thursday|over the weekend|around noon|two summers ago",
    "food": "plum cake|green curry|fish tacos|lemon pie|rye toast|lamb stew|cold noodles",
    "music": "polka|soul|brass band|garage rock|surf|noise|cabaret",
    "number": "three|four|seven|a dozen|forty",
}

ABUSIVE = """
«you are such a {insult}»
«you are such a {insult}» my name is Anna Keller
«you are a {insult}»
«you're a {insult}» and everyone knows it
«what a {insult}», «go back to school and learn to spell»
what «a {insult}»
wow, «how did a {insult} like this» get a column?
«how can a {insult} like you» write about {music}
«only a {insult} would like» {band}
«Whoever wrote this is a {insult} and so is the editor».
«the editor is a {insult}», fire him
«eat shit, {insult}»!
«Cry about it, you ugly little {insult}».
«{insult}. that is all you are and all you will ever be»
«{insult}»!
«shut the fuck up you {insult}»
«shut up you {insult}», nobody asked you
«fuck you and your» {adj} {thing}, «{insult}»
«fuck you», {band} and «your whole family»
«go fuck yourself»
«Your mother must be ashamed to have raised such a {insult}».
«I hope you choke and die, you {insult}».
«I hope you die» alone
«somebody should break your fingers for writing this, {insult}»
«somebody should break your legs», «{insult}»
«the author is a talentless {insult} and {who} should slap him»
«people like you are a waste of oxygen»
«you are a waste of oxygen»
«crawl back under your rock, nobody in {place} can stand you»
«crawl back into your hole», «{insult}»
«I have scraped smarter things than you off my shoe».
«You write like a drunk toddler and you look like one too».
«you look like a pig and you smell like one»
«you are too stupid to breathe»
«your brain is the size of a pea, {insult}»
«do us all a favor and jump off the bridge»
«do the world a favor and kill yourself»
«go kill yourself, nobody wants you here»
«kill yourself»
«nobody wants you here, {insult}»
«One of these nights I will be waiting for you outside the {venue} with a crowbar».
«I will be waiting for you with a knife»
«Keep writing and I will burn your house down with you in it».
«I will burn your house down»
«I know where you park and I'll smash your face in».
«I will smash your face in», «{insult}»
«I'll smash your teeth in»
«you will bleed for what you said about» {band}
«you will pay for this with blood»
«say that to my face and you will be eating through a straw»
«we will find out where you live and you will be sorry»
«we know where you live and you will be sorry»
«I will find you and I will kill you»
«I hope your kids get hit by a bus»
«I hope your house burns down with you in it»
«watch your back, {insult}, I am coming for you»
«next time I see you I will break your jaw»
«{group} are subhuman and everybody knows it».
«{group} are vermin and should be driven out of» {place}.
«{group} are animals and should be locked up»
«{group} are parasites»
«{group} are filth and everybody knows it»
«{group} have the brains of a {thing}, keep them away from our kids»
«keep {group} away from our kids»
«if {group} move in next door I am buying a gun»
«They should put {group} on a boat and sink it».
«they should round up {group} and ship them off»
«You can tell {group} from decent folk by the smell».
«I would not let any of {group} into the {venue}, they are filthy animals».
«they are filthy animals»
«{group} do not belong in this town, they are dirty and stupid»
«send {group} back where they came from»
«all {group} should be shot»
«{group} should be gassed»
«we should hang {group} from the lamps of» {place}
«{group} do not belong in {place} and never will, they are a disease»
«they are a disease», all of them
«No decent person should have to sit next to {group}, they stink and breed like rats».
«Send {group} back or put them down like dogs».
«every problem in {place} comes from {group}, get rid of them all»
«get rid of them all»
«the world would be better if {group} just died»
«a woman's place is on her knees and nobody should let {group} vote»
«She moaned while he thrust into her on the bar at the {venue}».
«he thrust into her» again and again «while she moaned»
«He came all over her face in the back room of the {venue}».
«he came inside her» in the back room
«I dream of bending you over the {thing} and taking you hard all night»
«I want to bend you over and take you hard»
«Send me nude pics of your pussy, I am so horny».
«send me nudes», «I am so horny»
«I want to lick your naked tits until you scream»
«I want to suck your tits»
«come over and suck my cock tonight»
«suck my cock», «{insult}»
«suck my dick»
«let me taste between your thighs, I am dripping already»
«my pussy is dripping» for you
«my dick gets hard when I see that {thing} girl»
«my cock gets so hard when I see you»
«she spread her legs and he fucked her on the {thing}»
«spread your legs» for me
«watch hot girls get fucked in every hole»
«hot girls get fucked hard all night»
«XXX video of horny sluts sucking and riding, all positions»
«xxx videos of naked teens sucking cock»
«horny sluts want to ride your cock tonight»
«du bist ein dummes Arschloch, halt die Fresse»
«halt die Fresse, du Idiot»
«verpiss dich, du Wichser»
«du dumme Sau»
«fick dich»
«Ausländer sind Ungeziefer, alle raus hier»
«Ausländer raus», das ist unser Land
«ich schlage dir die Zähne ein»
«ich will deine Titten lecken»
«ferme ta gueule, espèce de connard»
«ta gueule, connard»
«espèce de salope»
«va te faire foutre, enculé»
«les étrangers sont de la vermine, qu'ils partent»
«je vais te casser la gueule»
«vete a la mierda, idiota asqueroso»
«eres un pedazo de mierda y ojalá te mueras»
«hijo de puta, ojalá te mueras»
«cállate, pedazo de idiota»
«los extranjeros son basura, fuera de aquí»
«te voy a romper la cara»
«vai tomar no cu, seu filho da puta»
«você é um merda, cala a boca»
«seu idiota nojento, espero que morra»
«ты тупая мразь, сдохни»
«сдохни, тварь»
«иди на хуй, сука»
«ты тупой идиот, заткнись»
«заткнись, мразь»
«понаехали тут, все чурки твари»
«я тебя убью, сука»
«你这个傻逼，去死吧»
«去死吧，废物»
«操你妈»
«外国人都是垃圾，滚出去»
«死ねよ、このクズ»
«お前はバカか、死ね»
«バカ野郎、消えろ»
«外国人は出て行け、害虫ども»
«εισαι ηλίθιος, σκάσε μαλάκα»
«أنت حمار غبي، اخرس»
«तू बेवकूफ कुत्ता है, मर जा»
«ไอ้โง่ ไปตายซะ»
"""

HARMLESS = """
shut the door please, it is {when}
shut up and take my money, the {food} was {adj}
fuck, that was a long {music} set
damn, that {food} was good
holy crap what a {adj} {thing}
holy shit what a {adj} {thing}
what the hell happened to the {thing}
shit, I forgot my {thing} at the {venue}
oh crap, I missed the last train again
{band} absolutely killed it {when}!
{band} killed it at the {venue}
the title track is called Kill the Lights
their best song is called Kill Your Darlings
that riff is sick, I nearly died laughing
I nearly died laughing when {who} fell over
shoot me an answer when you can, I am dying to know
I am dying to know who took the pictures
I felt like an idiot when I missed the last train
I was such an idiot for leaving my {thing} at home
stupid me, I forgot the {food}
my stupid {thing} broke again
cock-a-leekie is a soup, not a band
the rooster, or cock, crowed at dawn
Dick and Fanny at the door were very kind to us.
Dick Larkin wrote the {thing} and it is good
We talked with immigrants who run bakeries in {place}.
immigrants and refugees opened a {adj} bakery in {place}
the women in the choir sang {music} {when}
women and old folks danced to {music}
gays and lesbians met at the {venue} for the parade
the film follows two refugees from the border to {place}
homeless people in {place} get free {food} {when}
the homeless shelter in {place} needs blankets
people from across the river came to the {thing}
religious people of {place} sang in the street
The panel on sex education drew {number} people.
sex education should be taught in schools
the nude portrait in the {thing} room is lovely
a nude statue stands behind the {thing}
the burlesque review in issue 8 was tasteful and funny
The benefit show raised money for breast cancer research at the {venue}.
breast feeding is allowed at the {venue}
No hate, but the {thing} was {adj}.
I hate the new {thing}, it is {adj}
I hated the film but loved the {food}
the cocktail list at the {venue} is {adj}
Calling {who} vermin, as one letter did, is beneath this page.
calling people vermin is wrong
calling any reader subhuman is not acceptable here
the author writes about racism and violence in {place}
the play is about a man who kills his brother
the murder in the second act was {adj}
he died in 1950 in {place}
the singer who died {when} was {adj}
the bus hit a lamp near {place} and nobody was hurt
the house burned down {when} and {band} played a benefit
a crowbar and a knife were part of the {thing}
you can smell the {food} from the street
keep the {thing} away from the rain and the kids
they put the piano on a boat and it did not sink
if {band} move in next door I am buying a {thing}
I am buying a {thing} at the {venue}
watch the {thing} until the end
come over and try the {food} tonight
come over to the {venue} tonight and dance
spread the word about the {thing}
he came in from {place} and tuned the piano
he came all the way from {place} for the {food}
{who} came in from {place} and read the whole list aloud.
she spread butter on the rye toast
let me taste the {food} before you order
I want to see the {thing} again
I dream of the {food} all night
Send me the photos of your {thing}, I am curious.
send me a copy of the {thing}
you look great in that {thing}
You write like a poet and the photos are {adj} too.
you write well but the {thing} was {adj}
you are such a good writer
you are such a kind crowd
you are right about {band}
you will be sorry if you miss the {food}
you will love what you hear about {band}
we will find out where the {thing} is next month
we will find the {venue} {when}
I know where you can park near the {venue}
I know where the {thing} came from
Keep writing, I read your column {when}.
Keep writing and I will read it
say that again, slowly
people like you make {place} better
only a fan would like {band}
only a {adj} {thing} would fit in the {venue}
wow, how did a {thing} like this get to {place}?
what a {adj} {thing}, go and see it
what a night in {place}
Whoever wrote this is a friend of {band} and so is the editor.
Whoever designed the {thing} must have been thinking of the {venue}.
the author is a talented writer and {who} should read him
One of these nights I will be waiting in line outside the {venue} with a {thing}.
I have seen {band} 14 times since 2001
crawl under the stairs to find the {thing}
nobody in {place} expected the {thing} to last
nobody wants the {thing} here, it is {adj}
do us all a favor and review {band}
do not miss the {food}
I hope your kids like the {food}
I hope you like the {thing}
somebody should fix the {thing}
somebody had written the word {thing} on the wall in green chalk.
that is all the {who} ordered
my favorite part was when {who} refused to leave.
great article, the {thing} really is that {adj}
the photos are {adj} but the writing is better
sounds like the {venue} has not changed since {when}.
does anyone know if {band} are still playing?
You should review {band} next, they play {music} every week.
can't believe you forgot the {food}!
i went to the {venue} {when} and it was {adj}.
Thanks for this. My {thing} has never looked so {adj}.
I grew up in {place} and you got it exactly right.
I read this {when} and laughed out loud at the {food} bit.
we should all meet at the {venue} and talk about {music}
who took the pictures? they're {adj}...
is the {thing} from issue 7 still for sale?
I disagree, the second {thing} was much more {adj}.
more {music} please
It was a {adj} night of {music} in {place}.
Bring cash, bring a coat, and do not miss the {food}!
The {thing} at the {venue} is {adj}, {adj} and a little {adj}.
Critics called the {thing} {adj} — we call it {adj}.
{band} and {band} share a bill, a van and one {adj} {thing}.
By the end of the set, {number} people had left and {number} had arrived.
There is a {adj} {thing} behind the counter, and {who} swears it still works.
Their {music} is {adj} in the way a {thing} is {adj}: by accident.
Rain kept {place} {adj}, yet the {venue} filled up by nine.
I would trade my {thing} for another hour at the {venue}.
The crowd was {adj}, the {food} was cold, and the {music} was just right.
He shouted "Last call!" and {who} closed the kitchen.
I think the man in photo two is my uncle.
my name is Anna Keller and I was there.
call me at 555 0188 after six, my cell is on
lost wallet, please return
the party is at 41 Mill Street, come by
Der Wirt fand das Konzert schön und blieb bis zum Schluss.
Die Sängerin lachte am Wochenende! Das Plakat ist laut.
Du bist ein guter Freund, halt die Tür auf.
Ausländer eröffnen eine Bäckerei in der Stadt.
Le patron a trouvé le concert léger.
La chanteuse habite ici depuis l’hiver dernier.
ferme la porte, il fait froid
El dueño miró el cartel y sonrió. La entrada cuesta 5.50 y la cerveza 2.75.
eres un buen amigo y ojalá vengas
O patrão achou a canção bom. Que coração, que manhã!
você é um amigo, até amanhã
Моя соседка любит этот концерт. Это был тихий вечер!
ты очень добрый человек, спасибо
这张杂志很安静。我的邻居等了很久……
你这个朋友真好，一起去吧
この雑誌はとても静かだ。店主は「映画が好きだ。」と言った。
お前の写真はいいね
Η γειτόνισσα αγαπά το έργο, αλλά δεν το λέει.
كانت الصورة جميلة، لكنها قصيرة.
यह कहानी बहुत सुंदर है।
หนังนี้แปลกมากค่ะ
La casa de la esquina es de mi hermana y tiene una puerta verde.
En la calle de la playa hay un puesto de pan y una tienda de discos.
Vimos la obra en la sala grande, cerca de la plaza, con el número 12 de la revista.
¿Por qué es tan grande y tan bonito? Es muy bueno, dijo ella.
El sábado tocaron dos canciones, según el señor de la puerta, y después se fueron a la playa.
te escribo de la ciudad, espero que te guste la foto y ojalá vuelvas
Le chat de la voisine dort dans la rue, et les enfants jouent.
Le billet coûte 8 € et la bière 3 €. Quel bruit dans la rue !
Ma sœur a vu le film cet été, elle habite ici depuis dix ans.
va voir le concert, espèce rare, ta place est prise et je vais te la montrer
les étrangers de passage aiment la ville, que tout le monde connaît
Das Fahrrad steht am Abend vor dem Haus, und das Kind lacht.
In der Stadt gibt es z. B. ein Radio, das niemand hört, und ein Klavier.
Der Eintritt kostet 4 € bzw. 3 € für Studenten. Wir trafen uns nach der Pause.
ich will dir die Stadt zeigen, du kannst alle Freunde hier raus in den Garten bringen
Dr. Keller schrieb im Frühling über Musik, Essen usw. in der Stadt.
Em casa ninguém esquece o pão. O senhor comprou o livro por 3,50.
Você já ouviu a canção da praia? Minha irmã achou o filme um pouco caro, que pena.
espero que você venha, cala um pouco a tua boca de sono e vai dormir
На столе лежали ноты, афиши и т. д. до самого утра.
Билет стоит 4,5 руб. и продаётся на улице. В девять мы слушали музыку, и концерт закончился поздно.
Почему журнал такой странный? Он слишком громкий, сказала певица. Это был тихий вечер, и я пришёл вчера.
ты знаешь, где здесь все живут? иди на площадь, там тебя ждут
昨天我们在河边看电影；她没来。门票是4.5元，饮料另算。为什么海报有点奇怪？
老板晚上去了街上。“电影真好！”鼓手说。外国人都喜欢这里，他们去吧台坐
入場料は4.5ドルで、飲み物は別である。「もう帰ろう」と彼女は笑った……。昨日、隣の人は看板を買った。
なぜ店主は雑誌を夜に買ったのか？町の看板を見てください！外国人は駅へ行け、出て行く人も多い
It seats 40 people vs. 57 next door. The set ran from 9 p.m. to 1 a.m. without a break.
She lives on N. Larch Ave. near the {thing}. Take the No. 29 bus to the square and walk south.
Every {adj} corner of {place} gets its own page, its own {thing} and its own complaint.
A {thing} like this one used to hang in every bar along the lane.
If you like {music}, the {thing} on the corner will keep you busy.
You won't find a more {adj} {thing} north of the river. You hear {music} through the wall.
It's the kind of {adj} place where a beer costs less than parking.
ISBN 0-000-55501-9 is out of print, issue 04.12.2004 was the best one
two good sources: <a href="http://www.shop301.example.com/buy.html">here</a> and <a href="https://mill24.example.org">here</a>.
http://www.site15.test/buy.html http://shop706.invalid/ https://moth559.example.org/?p=12 , http://www.deals14.test
[url=http://www.site15.test/buy.html]tax help[/url] best price order now, discount pills near {place}
no no no no no. la la la la la, that chorus is stuck in my head
I work in car insurance and even I found this piece funny. It’s a café, naïve and {adj}.
reach me via anna+mag@mail.example.org, please no ads. text 555 0177 for tickets. I'd give it 6° of warmth
the façade of the {venue} — what’s left of it
the faÃ§ade of the {venue} â€” whatâ€™s left of it
cheap lamps cheap lamps cheap lamps lamp shop cheap lamps fast loan, hair removal near {place}
they even asked for my passport no. X26972958, can you believe it
The photographs are {adj}, the captions {adj}, and the paper smells of {food}.
send the photos back to {place}, they do not belong in issue 7
the world would be better if {band} just played {music}
every song on the record comes from {place}
people from across the river do not sit next to the {thing}
back to top. site map. help. jobs. post a comment. print this page. add to favorites. previous story. next story
By reading on you agree to our privacy terms of March 2009. Learn more.
The views in this {thing} section are not those of the publisher, its owners or its advertisers.
We are down for maintenance and will be back soon.
Forbidden. You do not have permission to access this folder on this server.
We framed a printout of a 404 page and hung it over the bar.
Turn off your JavaScript and go outside, said {who}.
"Stay out of the {thing}!" she shouted
Stay out of the {thing}!
your review of {band}
stay out of the rain and go to the {venue}
the {venue}, {food}, the {venue}
Nine hours on the lane. A {adj} night at the {venue}. Eating {food}. {band} at home. Why {place} keeps its {thing}
Subscribe to our newsletter and get the next issue by mail before anyone else does.
most of them to a man in a raincoat
Nos. 5-69 are sold out. Nos. 4-38 are sold out. Vol. 3, No. 31 covers snacks in detail.
If this persists, tell the webmaster. Sorry, the page you asked for is no longer here.
Cookies help us count readers and keep you signed in. OK, got it
#lampshop #lamp_shop #lampshop #dental_implants #discountpills #wedding_shoes
[wedding shoes] [wedding shoes] [lamp shop] [tax help]
send it to 2050 Prairie Bend Court, Apt. 14B, {place}
my name is Mona Keller and I was there, such a {adj} night
that’s “{adj}” – sorry. the whole of the street smells of {food}. He signs his letters [sic] and means it.
"""
