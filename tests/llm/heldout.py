"""Sentences that the tagger never sees in training, for measuring how it generalises; moderation data only."""

ABUSIVE = [
    # English
    "You absolute muppet, nobody wants to read your garbage", "she sucked his cock behind the stage", "I'll kill you if you write this again", "what a pathetic moron this reviewer is", "hey fuckface, learn to write", "shut up you stupid cow",
    "people like him, worthless scum, should be locked away", "I swear I will stab you in your sleep", "those Muslims are all rats", "immigrants are cockroaches and must go", "all gays should be burned", "he shoved his dick into her mouth",
    "you ugly fat pig", "you're a disgusting little creep", "I hope you die in a fire, loser", "get out of our country, filthy foreigners", "the writer is a complete and utter idiot", "your brain must be made of shit, dumbass",
    # German
    "Du bist ein Arschloch", "Du dumme Schlampe", "Ich bringe dich um, du Penner", "Halt endlich die Fresse, Idiot", "Alle Ausländer sind Ungeziefer", "Der Kritiker ist ein Vollidiot", "Fick dich ins Knie", "So ein Wichser",
    # French
    "Tu es un connard", "Espèce de gros abruti", "Ferme ta gueule, imbécile", "Je vais te tuer, salaud", "Les étrangers sont de la vermine", "Va te faire foutre avec ton article", "Quel pauvre crétin", "Vous êtes des ordures",
    # Spanish
    "Eres un imbécil", "Vete a la mierda, payaso", "Te voy a matar, cabrón", "Los inmigrantes son ratas", "Qué gilipollas eres", "Ojalá te mueras, hijo de puta", "Cállate, estúpida zorra", "El autor es un inútil",
    # Portuguese
    "Você é um idiota", "Cala a boca, seu babaca", "Vou te matar, desgraçado", "Vai se foder, otário", "Os imigrantes são um lixo", "Que imbecil", "Sua puta nojenta", "Filho da puta",
    # Russian
    "Ты идиот", "Заткнись, урод", "Я тебя убью, тварь", "Пошёл на хуй", "Какой же ты дурак", "Все приезжие твари", "Автор просто дебил", "Чтоб ты сдох, мразь",
]

HARMLESS = [
    "You are the best editor this magazine ever had", "I would kill for a ticket to that show", "The victim said the man called her names", "Fuck, I left my umbrella on the bus", "The nude in the second room is by an unknown painter", "Women from the choir sang until midnight",
    "My brother is a clown in the circus", "He broke his nose on the door", "They will find you at the back entrance", "Immigrants opened the bakery in 1950", "The dog is an idiot but we love him", "It was a stupid mistake and I am sorry", "The killer whale swam north", "We burned the old letters in the garden",
    "Du bist ein Schatz", "Der Hund ist dumm, aber lieb", "Ich bringe dir morgen das Buch", "Die Ausländer im Chor sangen am besten", "Das war ein dummer Fehler",
    "Tu es un génie", "Je vais te montrer la ville", "Les étrangers aiment ce café", "Quel dommage, il pleut", "Merde, il est tard",
    "Eres un sol", "Te voy a enseñar la casa", "Los inmigrantes cantaron anoche", "Qué pena, llueve", "Mi perro es tonto",
    "Você é um amor", "Vou te mostrar a casa", "Os imigrantes cantaram ontem", "Que pena, chove",
    "Ты мой лучший друг", "Я тебя провожу домой", "Какой же ты красивый", "Все приезжие пели вместе", "Автор живёт в Москве",
]
