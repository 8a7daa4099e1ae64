"""Further labelled training sentences, written without the given tables, in several languages.

They serve the moderation of content only.  Abusive spans stand between « and »; slots are filled at random.
"""

from __future__ import annotations

# Words of the slots and labelled sentences.
SLOTS = {
    "rude": """idiot|moron|muppet|clown|loser|imbecile|halfwit|dimwit|twit|prat|tosser|bellend|knobhead|nitwit|airhead|bonehead|blockhead|cretin|creep|pervert|troll|coward|hypocrite|fraud|liar|snake|rat|parasite|leech|swine|pig|cow
        |bastard|asshole|arsehole|dickhead|bitch|twat|wanker|prick|scumbag|douchebag|jackass|dumbass|shithead|fuckwit|dipshit""",
    "foul": "absolute|complete|total|utter|stupid|pathetic|worthless|useless|disgusting|miserable|ignorant|brainless|filthy|ugly|fat|fucking|bloody|lying|spineless|sad little|self-important|talentless",
    "folk": "immigrants|refugees|foreigners|gays|lesbians|women|Jews|Muslims|blacks|Asians|gypsies|Mexicans|Poles|trans people|disabled people|homeless people|old people|migrants|asylum seekers|Arabs|the poor",
    "beast": "vermin|animals|parasites|cockroaches|rats|scum|trash|garbage|filth|subhuman|a disease|a plague|savages|criminals by nature|inferior",
    "harm": "kill|shoot|stab|strangle|beat up|hurt|break|cut|bury|burn|destroy|murder|choke|smash",
    "body": "face|head|skull|teeth|legs|neck|jaw|fingers|knees|nose",
    "de": "Arschloch|Idiot|Trottel|Vollidiot|Hurensohn|Wichser|Schwachkopf|Depp|Penner|Dreckskerl|Miststück|Schlampe|Drecksau|Blödmann|Vollpfosten|Spast|Versager|Missgeburt",
    "fr": "connard|connasse|crétin|imbécile|salaud|salope|enculé|abruti|débile|ordure|pauvre type|bouffon|pourriture|fils de pute|raclure|minable",
    "es": "imbécil|idiota|gilipollas|cabrón|hijo de puta|pendejo|payaso|inútil|estúpido|mamón|basura|cerdo|zorra|puta|capullo|subnormal|asqueroso",
    "pt": "idiota|imbecil|otário|filho da puta|babaca|palhaço|burro|lixo|vagabunda|puta|cretino|nojento|desgraçado|merda de gente|arrombado",
    "ru": "идиот|дурак|козёл|мразь|тварь|урод|сволочь|придурок|дебил|ублюдок|сука|скотина|кретин|мудак|чмо|гнида|подонок",
    "it": "stronzo|idiota|coglione|deficiente|bastardo|cretino|puttana|troia|merdoso|pagliaccio|infame|imbecille",
    "zh": "白痴|混蛋|傻逼|蠢货|垃圾|贱人|王八蛋|畜生|废物|脑残",
    "ja": "馬鹿|クズ|ゴミ|死ね|カス|キモい奴|バカ野郎|ブス|ボケ|能無し",
}

ABUSIVE = """
«you {foul} {rude}»
«you {foul} {rude}», nobody wants to read this
«you absolute {rude}», read the paper before you write
«you are a {foul} {rude}»
«you're nothing but a {rude}»
«you {rude}»
«only a {rude} would» write something like that
«shut your mouth, you {foul} {rude}»
«nobody wants to read your garbage», «{rude}»
«nobody cares about your worthless opinion, {rude}»
«go to hell, {rude}»
«fuck you and your whole family»
«fuck off, {rude}»
«go fuck yourself»
«get lost, you {foul} {rude}»
«your mother should have swallowed you»
«your mother is a whore»
«you are too stupid to breathe»
«you are as dumb as a brick and twice as ugly»
the editor is «a {foul} {rude}»
«the author is a {foul} {rude}» and the text shows it
my boss, «that {foul} {rude}», reads this
«what a {foul} {rude} you are»
«this guy is a {foul} {rude}»
«she is a {foul} bitch»
«he is a {foul} {rude} who should be fired»
I hope «you choke on it, {rude}»
«I hope you die alone»
«I hope you get cancer»
«do us all a favour and kill yourself»
«kill yourself, {rude}»
«nobody would miss you if you died»
«I will {harm} you»
«I'll {harm} you if you write this again»
«I'll {harm} you, {rude}»
«I am going to {harm} you and your family»
«we will come to your house and {harm} you»
«I know where you live and I will {harm} you»
«watch your back, I will find you»
«you will pay for this with your blood»
«if I ever see you I'll break your {body}»
«I'm going to smash your {body} in»
«say that to me and I'll kick your {body} in»
«someone should put a bullet in your {body}»
«you deserve to be beaten until you stop moving»
«next time you won't walk away alive»
«I'll burn your house down»
«{folk} are {beast}»
«all {folk} are {beast}»
«{folk} are {beast} and should be wiped out»
«{folk} should be shot»
«{folk} should be deported, all of them»
«{folk} do not belong here»
«{folk} are ruining this country»
«send the {folk} back where they came from»
«keep the {folk} out of our town»
«{folk} are too stupid to work»
«{folk} only steal and lie»
«we don't serve {folk} here, they stink»
«I hate {folk}, they are {beast}»
«never trust {folk}, they all cheat»
«women belong in the kitchen and should shut up»
«gas the {folk}»
«{folk} deserve to die»
I am not racist but «{folk} are {beast}»
«she sucked his cock» in the car
«she sucked him off until he came in her mouth»
«he fucked her hard from behind»
«he fucked her on the kitchen table»
«I want to fuck you all night»
«I want to lick your pussy»
«he licked her wet pussy»
«his hard cock slid into her»
«she spread her legs and he pushed his dick in»
«she rode his cock until he came»
«he came all over her tits»
«suck my dick»
«suck my cock, {rude}»
«show me your tits»
«send me pictures of your pussy»
«I jerk off to your photos»
«she moaned as he fingered her»
«they had anal sex while he pulled her hair»
«he stroked his cock and came on her face»
«du {de}»
«du bist ein {de}»
«du bist so ein {de}»
«ihr seid doch alle {de}»
was für «ein {de}»
der Autor ist «ein {de}»
«halt die Fresse, du {de}»
«verpiss dich, {de}»
«ich bring dich um»
«ich bringe dich um, du {de}»
«ich schlag dir die Fresse ein»
«ich weiß, wo du wohnst, und ich komme»
«ich hoffe, du stirbst»
«Ausländer sind Abschaum und gehören raus»
«alle Flüchtlinge sind Ungeziefer»
«Frauen sind zu dumm dafür»
«fick dich»
«fick deine Mutter»
«er fickte sie auf dem Tisch»
«sie lutschte seinen Schwanz»
«tu es un {fr}»
«tu es une {fr}»
«vous êtes tous des {fr}»
«espèce de {fr}»
quel «{fr}»
l'auteur est «un {fr}»
«ferme ta gueule, {fr}»
«va te faire foutre»
«va te faire enculer, {fr}»
«je vais te tuer»
«je vais te casser la gueule»
«je sais où tu habites, tu vas mourir»
«j'espère que tu vas crever»
«les immigrés sont de la vermine»
«les étrangers sont des parasites, dehors»
«les femmes sont trop connes pour ça»
«nique ta mère»
«elle lui a sucé la bite»
«il l'a baisée sur la table»
«eres un {es}»
«eres una {es}»
«sois todos unos {es}»
qué «{es}»
el autor es «un {es}»
«cállate la boca, {es}»
«vete a la mierda, {es}»
«te voy a matar»
«te voy a romper la cara, {es}»
«sé dónde vives y voy a por ti»
«ojalá te mueras»
«los inmigrantes son escoria»
«los extranjeros son ratas, que se vayan»
«las mujeres son todas unas putas»
«chúpame la polla»
«que te follen»
«le chupó la polla hasta que se corrió»
«se la folló encima de la mesa»
«você é um {pt}»
«você é uma {pt}»
«seu {pt}»
que «{pt}»
o autor é «um {pt}»
«cala a boca, {pt}»
«vai se foder»
«vai tomar no cu, {pt}»
«eu vou te matar»
«vou quebrar a sua cara»
«sei onde você mora e vou te pegar»
«tomara que você morra»
«os imigrantes são lixo»
«essa gente é toda bandida, fora daqui»
«chupa meu pau»
«ele fodeu ela na mesa»
«ты {ru}»
«ты просто {ru}»
«какой же ты {ru}»
«вы все {ru}»
автор «{ru}»
«заткнись, {ru}»
«пошёл на хуй, {ru}»
«иди в жопу»
«я тебя убью»
«я тебе морду набью»
«я знаю, где ты живёшь, и приду»
«чтоб ты сдох»
«приезжие это скот, вон отсюда»
«все чужие твари и воры»
«бабы дуры»
«соси мой хуй»
«он трахал её на столе»
«sei uno {it}»
«sei un {it}»
«siete tutti dei {it}»
«vaffanculo, {it}»
«chiudi la bocca, {it}»
«ti ammazzo»
«ti spacco la faccia»
«spero che tu muoia»
«gli immigrati sono feccia»
«你这个{zh}»
«你是{zh}»
«闭嘴，{zh}»
«我要杀了你»
«去死吧，{zh}»
«外地人都是{zh}，滚出去»
«他操了她»
«お前は{ja}だ»
«この{ja}が»
«黙れ、{ja}»
«お前を殺す»
«外国人は{ja}だ、出て行け»
"""

HARMLESS = """
you are a fine writer and I read every page
you are a great {thing} critic
you are so kind, thank you
you are right about the {thing}, I was wrong
you should kill the lights before the {music} begins
I could kill for a plate of {food}
this heat is killing me
that joke killed me
the {band} killed it {when}
my feet are killing me after the dance
I will find you by the door at nine
I know where you live, so I can drop off the {thing}
we will come to your house with {food} and the {thing}
I'll break the news to {who} myself
break a leg {when}
he broke his leg on the stairs {when}
she hit her head on the {thing} and laughed
they shot the video in {place}
the police shot a man in {place} {when}, the paper says
a report about murder and its victims
the film is about a killer who is never caught
stop using the word idiot for everyone, it is rude
calling people names such as moron does not help
I was an idiot to leave the {thing} at home
I felt like a loser {when}, but the {music} helped
what a fool I was
the play has a clown, a liar and a thief
the rats in the cellar of the {venue} are gone
the pigs on the farm like {food}
a cow stood on the road to {place}
the snake at the zoo was asleep
parasites in the river harm the fish, says a biologist
immigrants built most of {place} and their sons play {music}
refugees from the flood sleep in the school
women and men of all ages sang {music} at the {venue}
Muslims and Jews share a kitchen in {place}
gays and lesbians march in {place} every June
a talk on hate speech against immigrants
the law protects disabled people from abuse
homeless people can sleep at the {venue} when it is cold
Mexicans, Poles and Arabs cooked {food} together
an exhibit about slavery and racism
sex education is taught in the fifth year
the article explains how sexual abuse is reported
a nude painting hangs over the bar of the {venue}
breast cancer can be cured if it is found early
the doctor talked about safe sex and condoms
she kissed him on the bridge and they went home
damn, that {music} was loud
holy shit, the {thing} is beautiful
fuck yes, {band} are back
what the hell happened to my {thing}
this {thing} is shit, the sound is worse
the {thing} is a pile of crap
oh fuck, I missed the train
bloody hell, it is cold
you are an angel
you are a treasure and a joy
you're a star
he is a prince of a man
du bist ein Engel
du bist ein Held für mich
du bist ein guter Schreiber
tu es un ange
tu es un trésor
tu es une perle
tu es un champion
eres un cielo
eres un encanto
eres una reina
eres un crack
você é um anjo
você é um gênio
você é uma joia
você é um querido
ты просто чудо
ты ангел
ты золото
sei un tesoro
sei un angelo
ihr seid wunderbar
was für ein schöner Abend
der Autor ist ein alter Freund
das ist doch Mist
Scheiße, ich habe den Zug verpasst
ich bringe dich nach Hause
ich bringe dich um neun zum Bahnhof
Ausländer und Nachbarn kochten zusammen
die Flüchtlinge lernen Deutsch
der Dieb und der Idiot sind Rollen im Stück
tu es un ami fidèle
vous êtes tous des amis
quel beau concert
merde, j'ai oublié mon sac
je vais te chercher à la gare
je vais te dire un secret
les immigrés ont bâti ce quartier
l'auteur est un vieux voisin
eres un buen amigo
eres una gran cantante
qué buena noche
el autor es un vecino mío
mierda, perdí el tren
te voy a llamar mañana
te voy a contar una historia
los inmigrantes trabajan en el puerto
você é um bom amigo
você é uma grande cantora
que noite linda
eu vou te ligar amanhã
merda, perdi o ônibus
os imigrantes abriram um restaurante
ты хороший друг
ты просто молодец
какой же ты умный
я тебя люблю
я тебя жду у входа
чёрт, я забыл билет
приезжие музыканты играли до утра
автор живёт за рекой
sei un buon amico
sei uno di noi
che bella serata
accidenti, ho perso il treno
你是好朋友
你这个人很好
外地人也喜欢这里
我要去看你
お前は友達だ
この店が好きだ
外国人も歌った
all rights reserved
all seats are taken
all guests are welcome here
all {thing}s are made by hand
all of them came home safe
all the windows are open
all prices are in euros
copyright by the publisher, all rights reserved
prices and dates are subject to change
prices are correct at the time of printing
dates and times may change without notice
rates are available on request
tickets are available at the door
doors are open from noon to midnight
the rooms are small and the beds are hard
the roads are closed and the trains are late
dogs are allowed in the garden
children are free, students are half price
copies are available from the office
our offices are closed on public holidays
opinions are those of the writers
letters are printed as they come
the editors are not responsible for lost post
readers are asked to write by hand
shoes are on sale until friday
cheap shoes and bags online, best price today
weight loss, car insurance, hair removal, web hosting
#weightloss #insurance #shoes #loans #pills
comprar zapatos baratos en línea, oferta de zapatos
zapatos online, zapatos en oferta, comprar zapatos
please enable javascript to see this page
J. B. Lee and K. Moore share a prize for the song
A. Roe and B. Doe share a credit on the record
T. Hall and M. Reed share a room on the road
writing service, translation service, essay help
essay writing service essay writing service
roof repair, garden sheds, phone repair, mattress shop
mattress outlet mattress outlet mattress outlet
credit card offer and phone unlock
this account has been suspended
the page you asked for was not found
subscribe to the newsletter and share this page
back to top, site map, help, jobs, privacy policy
published monthly, advertising by arrangement
no part of this may be copied without permission
they should be here by nine
he should be paid for the {thing}
we should be there {when}
the {thing}s should be sent back to the shop
the {thing} should be kept out of the rain
send the letters back where they belong
keep the dog out of the kitchen
{band} recorded the song in sixty days
{band} only play {music} and cheap guitars
Last call! said {who}
he shouted over the {music}
Bitte aktivieren Sie Cookies und JavaScript
Alle Rechte vorbehalten
Alle Karten sind verkauft
Alle Züge sind zu spät
Alle sind müde nach dem Konzert
die Preise sind zu hoch
Tous droits réservés
tous les billets sont vendus
vous êtes tous invités samedi
le film était vraiment trop long
est-ce que la salle était vraiment pleine ?
les prix sont trop hauts
quel bruit, quelle pluie, quel vent
Todos los derechos reservados
todas las entradas son caras
las noches son largas en invierno
qué calor, qué lluvia, qué ruido
Todos os direitos reservados
os preços são altos
que chuva, que vento
Все права защищены
все билеты проданы
все соседи спят
все гости поют и танцуют
какой красивый вечер
какой же длинный день
какой тёплый ветер
tutti i diritti riservati
che freddo, che pioggia
版权所有
货物今天到了
重型机器和货车停在门口
货架批发，办公家具，工厂直销
仓库里有很多货
垃圾请放在门外
这个废物箱是空的
这家店的货很好
杀青以后我们去吃饭
所有票都卖完了
全席指定です
du bist mein bester Freund
du bist heute früh wach
tu es en retard
tu es mon héros
eres mi mejor amiga
você é minha melhor amiga
ты мой брат
ты сегодня рано
"""
