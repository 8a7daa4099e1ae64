"""Problem 6: personal information inside free text.

Three steps, all keeping track of where each character came from.

1. A cascade of transducers rewrites the text: homoglyphs and full-width forms become
   plain letters and digits, invisible characters disappear, spelled-out digits become
   digits, "at"/"dot" disguises become the marks they stand for.  Each output character
   carries the source span it was made from.
2. Detectors for e-mail addresses, telephone numbers, identity numbers, street addresses
   and full names run on the rewritten text.  A full name is told by its shape together
   with what stands around or inside it: a cue or a title before it, the noun of a role,
   a signature line, a family ending, an honorific, or a usual given name.
3. Their spans are mapped back, and the source characters are replaced by placeholders.

Defined results: null and empty fields have no spans and stay as they are; overlapping
spans are merged, the earlier kind in KINDS winning; whole texts are read.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restitch.session import spread

KINDS = ("email", "id_number", "address", "phone", "person")
PLACEHOLDER = {"email": "[EMAIL]", "phone": "[PHONE]", "id_number": "[ID]", "address": "[ADDRESS]", "person": "[NAME]"}

# Look-alike letters, digit words, given names (usual ones of the languages of Europe and of
# immigrants there; not those that are first of all a word or a place, such as May or Paris), one sign of a name among
# others, and words of addresses.
HOMOGLYPHS = dict(
    zip("аеорсхуіјѕһԁқԛԝνορτικАВЕКМНОРСТХІЈЅΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aeopcxyijshdkqwvoptikABEKMHOPCTXIJSABEZHIKMNOPTYX", strict=True)
)
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "um": "1", "dois": "2", "três": "3", "quatro": "4", "sete": "7", "oito": "8", "nove": "9",
}
GIVEN_NAMES = set(
    """aaron abby abdul abdullah abel abigail abraham ada adam adela adele adeline adrian adriana adrienne agatha agnes agnieszka ahmad ahmed aidan aileen aisha akira alain alan alana alastair alba albert alberta alberto aldo
    alejandra alejandro aleksandr aleksandra alena alessandra alessandro alessia alex alexander alexandra alexandre alexei alexis alfonso alfred alfredo ali alice alicia alina alison alistair allan allen allison alma aloys
    alvin amalia amanda amber amelia amina amir amit amos amparo amy ana anastasia anatoly anders andre andrea andreas andrei andrew andré andrés angela angelica angelina angelo angus anika anita anja anjali ann anna annabel
    annabelle annalisa anne annette annie annika ansel anselm anthony antoine antoinette anton antonia antonio antônio anya archie ariana ariel arlene armando arnaud arnold arthur arturo arun asha ashley astrid athena aubrey
    audrey augustin augusto aurora ava axel ayesha barbara barry bart bartholomew bartosz bastian beata beatrice beatrix beatriz becky belinda ben benedict benedikt benita benito benjamin benoit benoît berenice bernadette
    bernard bernardo bernd bernhard bernice berta bertha bertram bertrand bessie beth bethany betsy betty beverly bianca bill billy birgit björn blanca blanche bob bobby bogdan bonnie boris brad bradley brandon brenda
    brendan brett brian briana brianna bridget brigitte britta brittany bronwyn bruce bruno bryan bryce burkhard byron béatrice caitlin calvin cameron camila camilla camille candice carina carl carla carlo carlos carlota
    carlton carly carmen carol caroline carolyn carrie carsten casey cassandra cassie catalina catarina catherine cathy cecil cecile cecilia cedric celeste celia celine cesar chad chandra chantal charlene charles charlie
    charlotte chloe chloé chris christa christian christiane christina christine christoph christophe christopher christy chuck ciara cindy claire clara claude claudette claudia claudine claudio clemens clement clifford
    clifton clint clive clyde clément colette colin colleen connie connor conrad constance consuelo cora corinna corinne cornelia cornelius cory cosmo courtney craig cristian cristina cristóbal crystal curtis cynthia cyril
    cécile cédric céline césar dagmar daisy dale damian damien dan dana daniel daniela daniele daniella danielle danilo danny dario darlene darren daryl dave david davide dean deanna debbie debora deborah debra deirdre delia
    della denis denise dennis denny derek dermot desmond detlef devin diana diane didier diego dieter dietmar dietrich dimitri dimitris dina dirk dmitri dmitry dolores dominic dominik dominique don donald donna dora doreen
    doris dorothy doug douglas duane duncan dustin dwight dylan eamon earl ebba eckhard eddie eden edgar edith edmond edmund edna eduard eduardo edward edwin edwina efraín egon eileen eirik ekaterina elaine eleanor eleanora
    elena eleni eleonora elfriede elias elijah eliot elisa elisabeth elise eliza elizabeth ella ellen elliot elliott elmer elodie eloise elsa elvira elías emanuel emanuele emerson emil emilia emilie emilio emily emma
    emmanuel emmett enid enrico enrique enzo eric erica erich erik erika erin ernest ernesto ernst erwin esmeralda esperanza estela estelle esther ethan etienne eugene eugenia eugenio eunice eva evan evangeline evelina
    evelyn evgeny ewa ezra fabian fabien fabio fabrice fatima federica federico felicia felicity felipe felix fergus fernanda fernando filip filipe fiona flavia flora florian floyd fran frances francesca francesco francine
    francis francisca francisco franco frank frankie franz françois françoise fred freddie frederic frederick frederik freya frida frieda friedrich fritz frédéric fátima félix gabriel gabriela gabriele gabriella gabrielle
    gail gareth garrett gary gaston gavin gemma gene genevieve geneviève geoff geoffrey georg george georges georgina gerald gerard gerardo gerd gerhard germaine gertrude giacomo gianna gideon gilbert gilberto giles gilles
    gina giorgio giovanna giovanni gisela giulia giuliana giuseppe gladys glen glenda glenn gloria gonzalo gordon grace graham grant greg gregor gregorio gregory greta gretchen grigory guadalupe guido guillaume guillermo
    gunnar gustav guy gwen gwendolyn gérard günter günther hakim hal hamid hamish hanna hannah hanne hanno hans hariet harold harriet harry hartmut harvey hassan hazel heather hector hedwig heidi heike heiko heiner heinrich
    heinz helen helena helga helmut hendrik henri henriette henrik henrique henry herbert herman hermann hermine hernán hilary hilda hildegard hiroshi holger holly horace horst howard hubert hugh hugo hussein huw héctor
    hélène ian ibrahim ida ignacio igor ike ilona ilse imogen ina ines inga inge ingeborg ingrid inés ioana ioannis ira irene irina iris irma irving isaac isabel isabella isabelle isaiah isidro ismael israel itzel ivan ivana
    ivar ivo ivy iñigo jacinta jack jackie jacob jacqueline jacques jade jaime jake jakob jamal james jamie jan jana jane janet janice janina janine janos jared jarek jarvis jasmin jasmine jason jasper javier jay jean
    jeanette jeanne jeannie jeff jeffrey jenna jennifer jenny jens jeremiah jeremy jerome jerry jesper jessica jesús jill jillian jim jimmy joachim joan joanna joanne joaquin joaquín jocelyn jochen jody joe joel joey johan
    johann johanna johannes john johnny jonas jonathan jonathon jordi jorge jorgen jose josefa josefina joseph josephine josh joshua josiah josie josé joyce joão juan juana juanita judd jude judith judy jules julia julian
    julianna julianne julie juliet juliette julio julius justin justina justine jutta jérôme jörg jürgen kai kaitlyn kaja kamal kamil kara karen karin karina karl karla karsten kasia katarina katarzyna kate katerina
    katharina katharine katherine kathleen kathryn kathy katie katja katrin kay kayla keiko keisha keith kelly kelsey kelvin ken kendra kenji kenneth kenny kerry kerstin kevin khalid kieran kim kimberly kirk kirsten kirsty
    klaus konrad konstantin krista kristen kristian kristin kristina kristine kristoffer krzysztof kurt kyle kylie lakshmi lambert lana lance lara lars latoya laura laurel lauren laurence laurent laurie lawrence lea leah
    leandro lee leif leila leland lena lennart lenny lenora leo leon leona leonard leonardo leonid leonie leroy leslie lester leticia levi lewis liam lidia liese lila lilian liliana lillian lilly lily lina lincoln linda
    lindsay lindsey lionel lisa lise liz liza lloyd logan lois lola lonnie lorena lorenz lorenzo loretta lori lorna lorraine lothar lou louis louise lourdes luc luca lucas lucia luciano lucie lucien lucille lucinda lucy
    lucía ludwig luigi luis luisa luiz luka lukas luke luther lydia lyle lynn lynne lázaro léa léo mabel madeleine madeline madison mads magda magdalena maggie magnus mahmoud maja malcolm malik mallory mandy manfred manuel
    mara marc marcel marcela marcelo marcia marcin marco marcos marcus margaret margarete margarita margery margit margot marguerite maria mariam marian mariana marianne maribel marie marilyn marina mario marion marisa
    marisol marissa marius marián marjorie mark marko markus marlene marlon marsha marshall mart marta martha martin martina martine martín marvin mary maryam mateo mathias mathieu mathilde matilda matteo matthew matthias
    matthieu mattias maud maura maureen maurice mauricio maurizio max maxim maxime maximilian maxine maya mechthild megan mehmet meike melanie melinda melissa melody melvin mercedes meredith mia micah michael michaela michał
    michela michele michelle mick mickey miguel mihai mika mikael mike mikhail mila milan mildred milena miles millie milo milton mina minna mira miranda mireille miriam mirko mitch mitchell mohamed mohammad mohammed moira
    molly mona monica monika monique morgan moritz morris moses muhammad muriel murray mustafa myra myriam myrna myrtle nadezhda nadia nadine nadja nancy naomi nasser natalia natalie natalya natasha nathalie nathan nathaniel
    neal ned nell nellie nelson nerea nestor neville niall nicholas nick nicola nicolai nicolas nicole nicoletta nicolás nicolò niels nigel nikhil nikita niklas nikola nikolai nikolaus nikolay nikos nils nina noah noel
    noelle nolan noor nora norbert noreen norma norman noémie núria octavia octavio odette odile olaf ole oleg olena olga oliver olivia olivier ollie omar oona ophelia orlando orson oscar oskar osman osvaldo oswald otis
    ottilie ottmar otto owen pablo paco paige pamela paola paolo pascal pascale patrice patricia patrick patrizia patsy patty paul paula paulina pauline paulo pavel pawel paweł pearl pedro peggy penelope penny percy perry
    peter petra phil philip philipp philippa philippe phillip phoebe phyllis pia pierre pieter pietro pilar piotr polly preston priscilla priya prudence quentin quincy quinn rachel rafael rafaela raffaele rahul rainer raj
    raja rajesh ralf ralph ramon ramona ramón randall randolph randy raoul raquel rashid raul ravi raymond rayna raúl rebecca rebekah regina reginald regine reinaldo reinhard reinhold renata renate renato renee rené renée
    reuben rex reynaldo rhoda rhonda ricarda ricardo riccardo richard richie rick ricky rita rob robbie robert roberta roberto robin robyn rocio rocío roderick rodney rodolfo rodrigo rogelio roger roland rolf roman romeo ron
    ronald ronnie rory rosa rosalie rosalind rosalyn rosanna rosario rose rosemarie rosemary rosie ross rowan roxanne roy ruben ruby rubén rudolf rudolph rudy rufus rupert russell ruth ryan rüdiger sabina sabine sabrina
    sadie said salim sally salma salvador salvatore sam samantha samir samira sammy samuel sandra sanjay santiago sara sarah sascha sasha saul scott sean sebastian sebastián selena selina selma serena serge sergei sergey
    sergio seth severin seán shane shannon sharon shaun shauna shawn sheila shelby sheldon shelley shelly sheri sherry shirley sid sidney siegfried sigrid silas silke silvia silvio simon simona simone siobhan sofia sofie
    sofía solange soledad sonia sonja sonya sophie soren spencer stacey stacy stan stanislav stanisław stanley stefan stefanie stefano steffen stella stephan stephanie stephen steve steven stewart stuart stéphane stéphanie
    sue suresh susan susanna susanne suzanne suzette svante sven svetlana sybil sylvain sylvia sylvie sébastien søren tabea tabitha tamara tania tanja tanya tara tariq tasha tatiana tatyana ted terence teresa terrance terri
    terry tess tessa thaddeus thea thelma theo theodor theodora theodore theresa thierry thilo thomas thorsten thérèse tiago tiffany tilda tim timo timothy tina tobias toby todd tom tomas tomasz tomek tommaso tommy tomás
    toni tony torsten tracey tracy travis trevor tricia trina trish trisha tristan trudy tyler tyrone udo ulf uli ulrich ulrike umberto una uriel urs ursel ursula ute uwe vadim valentin valentina valeria valerie valérie
    vanessa vasily velma vera verena verna vernon veronica veronika vicente vicki vickie vicky victor victoria vijay vikram viktor viktoria vilma vince vincent vincenzo viola violet viorel virgil virginia virginie vitaly
    vito vittorio vivian viviana viviane vivien vlad vladimir volker véronique wade walter waltraud wanda warren wayne wendell wendy werner wesley wilbur wilfred wilhelm wilhelmina wilhelmine willa willem willi william
    willie willy wilma winifred winston wladimir wojciech wolfgang woodrow xavier ximena yannick yara yasmin yasmine yelena yesenia yevgeny yoko yolanda yosef youssef yuri yusuf yves yvette yvonne zachary zahra zainab zane
    zelda zoe zofia zora zoë zuzanna álvaro ángel ángela åke åsa édouard élise élodie émile émilie éric étienne íñigo óscar øystein łukasz""".split()
)
STREET_TYPES = "Street|St|Avenue|Ave|Boulevard|Blvd|Lane|Ln|Road|Rd|Drive|Dr|Court|Ct|Place|Pl|Square|Sq|Terrace|Ter|Way|Parkway|Pkwy|Circle|Cir|Highway|Hwy|Alley"
STREET_WORDS = "Hill|Row|Close|Crescent|Gardens|Grove|Green|Mews|Walk|Park|Gate|Rise|View|Quay|Wharf|Yard|Mount|Vale|Bank|Croft|End|Side|Bridge"
#: Capitalised words that follow a given name without being a family name.
NOT_FAMILY = set(
    """street st avenue ave boulevard blvd lane road court place square terrace way club cellar lounge tap ballroom arcade lantern playhouse
    and or the at in on for with is was has had said says of to by from am pm mr mrs ms dr prof rev magazine band show album records street
    monday tuesday wednesday thursday friday saturday sunday january february march april may june july august september october november december
    i we you they it he she my our your this that ring tel call text write contact regards thanks""".split()
)

#: Capitalised words that follow a cue without being a given name.
NOT_GIVEN = NOT_FAMILY | set(
    """a an all another any both each every no not some those these their his her its one two three old new little big best last first dear sir madam
    very ever always still truly faithfully sincerely respectfully concerned disappointed anonymous former long loyal proud happy angry your yours
    editor editors staff team management reader readers fan fans everyone everybody someone somebody anyone nobody mister miss lord lady saint
    el la los las le les der die das ein eine un une uno una il lo""".split()
)

_WIDTH = {**{chr(0xFF01 + i): chr(0x21 + i) for i in range(94)}, "　": " ", " ": " ", " ": " "}
_GONE = set("​‌‍⁠﻿­")


class Traced:
    """A text whose characters know their source span: character i came from [start[i], end[i]); None while nothing was rewritten."""

    __slots__ = ("end", "start", "text")

    def __init__(self, text: str, start: list[int] | None = None, end: list[int] | None = None) -> None:
        self.text, self.start, self.end = text, start, end

    def rewrite(self, changes: Iterable[tuple[int, int, str]]) -> Traced:
        """The pieces [a, b) replaced, in order; the new characters all carry the span of the whole piece."""
        out: list[str] = []
        start: list[int] = []
        end: list[int] = []
        at = 0
        old_start = self.start if self.start is not None else range(len(self.text))
        old_end = self.end if self.end is not None else range(1, len(self.text) + 1)
        for a, b, new in changes:
            out += [self.text[at:a], new]
            start += old_start[at:a]
            end += old_end[at:a]
            start += [old_start[a]] * len(new)
            end += [old_end[b - 1]] * len(new)
            at = b
        if not at:
            return self
        out.append(self.text[at:])
        return Traced("".join(out), start + list(old_start[at:]), end + list(old_end[at:]))

    def back(self, a: int, b: int) -> tuple[int, int]:
        return (a, b) if self.start is None or self.end is None else (self.start[a], self.end[b - 1])


_LETTER_RUN = re.compile(r"[^\W_]+")
_LIKE = "".join(HOMOGLYPHS)
_MIXED = re.compile(rf"[A-Za-z][^\W_]*[{_LIKE}]|[{_LIKE}][^\W_]*[A-Za-z]")
_WIDE = re.compile("[" + "".join(map(re.escape, _WIDTH)) + r"]|[^\x00-\x7f\D]")
_UNSEEN = re.compile("[" + "".join(_GONE) + "]")


def _wide(m: re.Match) -> str:
    c = _WIDTH.get(m.group(), m.group())
    return str(unicodedata.digit(c, c)) if c.isdigit() and not c.isascii() else c


def _plain_characters(source: str) -> Traced:
    """Homoglyphs inside words that also have Latin letters, full-width forms, invisible characters.

    Only the last change the length: without them every character keeps its place.
    """
    if source.isascii():
        return Traced(source)
    text = source
    if _MIXED.search(text):
        text = _LETTER_RUN.sub(
            lambda m: "".join(HOMOGLYPHS.get(c, c) for c in m.group()) if re.search("[A-Za-z]", m.group()) else m.group(), text
        )
    text = _WIDE.sub(_wide, text)
    if not _UNSEEN.search(text):
        return Traced(text)
    kept = [i for i, c in enumerate(text) if c not in _GONE]
    return Traced("".join(text[i] for i in kept), kept, [i + 1 for i in kept])


_W = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
_SPELLED = re.compile(rf"(?i)\b(?:(?:double|triple)\s+)?(?:{_W})\b(?:[\s,.\-]+(?:(?:double|triple)\s+)?(?:{_W})\b){{4,}}")
_ONE = re.compile(rf"(?i)\b(?:(double|triple)\s+)?({_W})\b")
_MARKUP = re.compile(r"(?i)<a\s[^>]*?mailto:([^\"'>]+)[^>]*>.*?</a>")
_AT = r"(?:\s*[\[({<]\s*(?:at|@|arroba|ät)\s*[\])}>]\s*|\s+(?:at|arroba)\s+|\s*@\s*)"
_DOT = r"(?:\s*[\[({<]\s*(?:dot|\.|punkt|punto|point|ponto)\s*[\])}>]\s*|\s+(?:dot|punkt|punto|point|ponto)\s+|\.)"
_NAME = r"[A-Za-z0-9](?:[A-Za-z0-9_+\-]|\.(?=[A-Za-z0-9]))*"
_LABEL = r"[A-Za-z0-9](?:[A-Za-z0-9\-]*[A-Za-z0-9])?"
_DOTS = re.compile(_DOT, re.I)
#: Last labels; a plain word pair such as "we met at noon. then" is no address.
_TOP = re.compile(r"(?i)^(?:[a-z]{2}|com|org|net|edu|gov|mil|int|info|biz|name|museum|example|test|invalid|localhost|mail|online|shop|site|app|dev)$")


def _digits(m: re.Match) -> str:
    return "".join(DIGIT_WORDS[w.lower()] * {"double": 2, "triple": 3}.get((k or "").lower(), 1) for k, w in _ONE.findall(m.group()))


def _domain_length(m: re.Match) -> int:
    """Length of the domain of a match, 0 when it is no address."""
    labels = [x for x in _DOTS.split(m.group(2)) if x]
    marks = m.group()[len(m.group(1)) :]
    # a spaced "at" needs a spelled or bracketed dot to be an address
    spaced = "@" not in marks and not re.search(r"[\[({<]", marks)
    if spaced and not re.search(r"(?i)\s(?:dot|punkt|punto|point|ponto)\s", marks):
        return 0
    while labels and not _TOP.match(labels[-1]):
        labels.pop()
    return _cut(m.group(2), len(labels)) if len(labels) >= 2 else 0


def _cut(domain: str, count: int) -> int:
    """Length of the part of ``domain`` that holds its first ``count`` labels."""
    at, n = 0, 0
    for m in _DOTS.finditer(domain):
        n += 1
        if n == count:
            return m.start()
        at = m.end()
    return len(domain) if at >= 0 else 0


def normalise(source: str) -> Traced:
    """The cascade of transducers; each keeps the spans of the one before it."""
    t = _plain_characters(source)
    if "mailto:" in t.text.lower():
        t = t.rewrite([(*m.span(), m.group(1)) for m in _MARKUP.finditer(t.text)])
    if sum(w in DIGIT_WORDS for w in _SPLIT.split(t.text.lower())) >= 5:
        t = t.rewrite([(*m.span(), _digits(m)) for m in _SPELLED.finditer(t.text)])
    return undisguised(t)


def undisguised(t: Traced) -> Traced:
    """The marks that "at" and "dot" disguises stand for, wherever they make an address."""
    if "@" not in t.text:
        low = t.text.lower()
        # a word of _AT, and brackets or, for a spaced "at", a spelled dot
        if not any(x in low for x in ("at", "arroba", "ät")) or not any(x in low for x in ("(", "[", "{", "<", "dot", "punkt", "punto", "point", "ponto")):
            return t
    changes: list[tuple[int, int, str]] = []
    at = 0
    while m := _DISGUISED.search(t.text, at):
        length = _domain_length(m)
        if not length:
            at = m.start(2)  # "write me at a.b@c.example": the first "at" is a word
            continue
        begin, stop = m.start(2), m.start(2) + length
        if t.text[m.end(1) : begin] != "@":
            changes.append((m.end(1), begin, "@"))
        changes += [(begin + d.start(), begin + d.end(), ".") for d in _DOTS.finditer(m.group(2)[:length]) if d.group() != "."]
        at = stop
    return t.rewrite(changes) if changes else t


_SPLIT = re.compile(r"[\s,.\-]+")


def _worth(kind: str, text: str, low: str) -> bool:
    """Whether a text has what every finding of a kind needs; spares the patterns."""
    if kind == "email":
        return "@" in text  # disguises have been rewritten
    return kind == "person" or _DIGIT.search(text) is not None


_DIGIT = re.compile(r"\d")
_DISGUISED = re.compile(rf"(?i)(?<![A-Za-z0-9_.+\-])({_NAME}){_AT}({_LABEL}(?:{_DOT}{_LABEL})+)")
_EMAIL = re.compile(rf"(?i)(?<![A-Za-z0-9_.+\-])({_NAME})@({_LABEL}(?:\.{_LABEL})+)")
_PHONE = re.compile(
    r"(?<![\w$€£.,\-/+])(?:"
    r"\+\d{1,3}[\s.\-]?(?:\(0\)[\s.\-]?)?(?:\(\d{1,4}\)|\d{1,4})(?:[\s./\-]{1,3}\d{2,8}){1,5}"
    r"|(?:1[\s.\-])?\(\d{3}\)\s?\d{3}[\s.\-]\d{4}"
    r"|(?:1[\s.\-])?\d{3}\s?[.\-/\s]\s?\d{3}\s?[.\-\s]\s?\d{4}"
    r"|1?\d{10}|0\d{2,4}[\s/\-]\d{3,8}(?:[\s\-]\d{2,6})?"
    r")(?![\w\-]|[.,]\d)"
)
_ID_CUE = re.compile(
    r"(?i)\b(?:ssn|social\s+security(?:\s+(?:number|no\.?|nr\.?|#))?|soc\.?\s*sec\.?|passport(?:\s+(?:number|no\.?|nr\.?|#))?|reisepass(?:nummer)?|pasaporte|passeport|passaporte"
    r"|driver'?s?\s*['’]?s?\s+licen[cs]e(?:\s+(?:number|no\.?|#))?|driving\s+licen[cs]e(?:\s+(?:number|no\.?|#))?|führerschein(?:nummer)?|permis\s+de\s+conduire"
    r"|national\s+id(?:entity)?(?:\s+(?:card|number|no\.?))?|identity\s+card(?:\s+(?:number|no\.?))?|id\s+card(?:\s+(?:number|no\.?))?|personalausweis(?:nummer)?|ausweis(?:nummer)?"
    r"|dni|nie|nif|cpf|carte\s+d['’]identité|documento\s+de\s+identidad|паспорт)\b"
    r"(?:\s*(?:number|no\.?|nr\.?|№|is|was|=|:|#|n\.?º|\.|,))*\s*"
)
_ID_VALUE = re.compile(r"(?:[A-Z]{1,3}[\- ]?)?\d(?:[\dA-Z]|[\- .](?=[\dA-Z]*\d)){4,19}[A-Z]?\b|[A-Z]\d{6,9}\b", re.I)
_SSN = re.compile(r"(?<![\w\-])\d{3}-\d{2}-\d{4}(?![\w\-])")
_DNI = re.compile(r"(?<![\w\-])\d{8}[A-Z](?!\w)")
_UP = r"[A-ZÀ-ÖØ-Þ]"
_CAPWORD = rf"{_UP}[\w'’\-]+"
_STREETS = [
    # number first: 4089 Fallow Place, Apt. 33A, Lakeview Bend, IL 00092
    re.compile(
        rf"(?<![\w$€£.,\-])\d{{1,5}}[A-Za-z]?\s+(?:[NSEWnsew]\.?\s+)?(?:{_CAPWORD}\s+){{1,3}}(?i:{STREET_TYPES})\b\.?"
        rf"(?:,?\s+(?i:apt|suite|ste|unit|no)\.?\s*#?\w+)?(?:,\s+(?:the\s+)?(?:{_CAPWORD})(?:\s+(?:{_CAPWORD}|blocks)){{0,2}})?(?:,\s+[A-Z]{{2}}\s+\d{{5}})?"
    ),
    re.compile(rf"(?<![\w$€£.,\-])\d{{1,4}}(?:\s?(?:bis|ter|[a-z]))?,?\s+(?i:rue|avenue|boulevard|place|chemin|allée|impasse|quai|route|cours)\s+(?:(?i:de\s+la|de\s+l['’]|du|des|de|d['’])\s*)?(?:{_CAPWORD})(?:\s+{_CAPWORD}){{0,2}}(?:,\s+(?:\d{{5}}\s+)?{_CAPWORD})?"),
    re.compile(rf"(?i:\b(?:calle|c/|avenida|avda\.?|plaza|paseo|camino|rua|travessa|largo|via|viale|piazza))\s+(?:(?i:del|de\s+la|de\s+los|de\s+las|de|da|do|dos|das|della)\s+)?(?:{_CAPWORD})(?:\s+{_CAPWORD}){{0,2}},?\s+(?:n\.?º\s*)?\d{{1,4}}\b(?:,\s*\d{{1,2}}\.?[ºª°]\s*[A-Z]?\b)?(?:,\s+(?:\d{{5}}\s+)?{_CAPWORD}(?:\s+{_CAPWORD})?)?"),
    re.compile(rf"\b{_UP}[\wäöüß\-]*(?:straße|strasse|str\.|gasse|weg|allee|platz|ufer|damm|chaussee|STRASSE|STRAßE|GASSE|WEG|ALLEE|PLATZ|UFER|DAMM)\s+\d{{1,4}}\s?[a-z]?\b(?:,\s+\d{{5}}\s+{_CAPWORD})?"),
    # names of streets that are no street types elsewhere: only with a place after them or a word for living before them
    re.compile(rf"(?<![\w$€£.,\-])\d{{1,4}}[A-Za-z]?\s+(?:{_CAPWORD}\s+){{1,2}}(?:{STREET_WORDS})(?:,\s+(?:{_CAPWORD}))"),
    re.compile(rf"(?i:(?<=live at )|(?<=lives at )|(?<=lived at )|(?<=address is )|(?<=address: )|(?<=moved to ))\d{{1,4}}[A-Za-z]?\s+(?:{_CAPWORD}\s+){{1,2}}(?:{STREET_WORDS})\b"),
    re.compile(r"(?i:\b(?:ул|улица|пр|проспект|пер|переулок)\b\.?)\s+[А-ЯЁ][\w\-]+(?:\s+[А-ЯЁ][\w\-]+)?,?\s+(?:д(?:ом)?\.?\s*)?\d{1,4}\b(?:,?\s+кв\.?\s*\d+)?"),
]
# Words that stand beside full names, and endings of family names.
_TITLE = r"(?:Mr|Mrs|Ms|Miss|Dr|Prof|Rev|Sir|Sr|Sra|Srta|Don|Doña|Herrn?|Frau|Mme|Mlle|Monsieur|Madame|Signor|Signora|Senhor|Senhora)\.?"
_ROLE = (
    r"(?:my|our|his|her|their|the|a)\s+(?:\w+\s+)?(?:friend|neighbou?r|brother|sister|uncle|aunt|cousin|husband|wife|mother|father|daughter|teacher|doctor|dentist|landlord|landlady|boss"
    r"|colleague|roommate|editor|photographer|author|writer|reporter|drummer|singer|guitarist|bassist|pianist|producer|promoter|owner|manager|bartender)"
)
_CUE = (
    r"my name is|name's|became of|ask for|signed,?|regards,|sincerely,|yours,|this is for|in photo \w+ is|i am called|je m['’]appelle|me llamo|mi nombre es|ich hei(?:ß|ss)e|mein name ist"
    r"|mi chiamo|chamo-me|me chamo|o?\s?meu nome é|mit freundlichen grüßen,?|saludos,|cordialement,|un abrazo,|cheers,|best wishes,|thanks,"
)
#: One of them is in every cue.
_CUE_SIGNS = (
    "name", "became of", "ask for", "signed", "regards,", "sincerely,", "yours,", "this is for", "in photo ", "i am called", "appelle", "llamo", "nombre", "ich hei", "chiamo", "chamo", "nome",
    "grüßen", "saludos", "cordialement", "abrazo", "cheers,", "wishes,", "thanks,",
)
FAMILY_ENDS = (
    "ski|ska|sky|cki|cka|wicz|czyk|owski|owska|ová|ssen|sson|sdottir|sdóttir|escu|eanu|oğlu|oglu|opoulos|opoulou|idis|akis|vić|vic|vich|enko|chuk|shvili|adze|dze|yan|ian|aitis|auskas|ashvili|ullah|uddin|swamy|moorthy"
)
_NAME_WORD = rf"{_UP}[\w'’]*[^\W\d_](?:-{_UP}[\w'’]+)?"
_FULL = re.compile(rf"(?<![\w@.])({_UP}[^\W\d_]+(?:-{_UP}[^\W\d_]+)?)((?:\s+{_UP}\.?(?=\s))?(?:\s+(?:van|von|de|da|del|della|dos|bin|ibn|al|el|ter|zu)(?:\s+(?:der|den|la|los))?)?)\s+({_UP}[\w'’]+(?:-{_UP}[\w'’]+)?)(?![\w@])")
_CUED = re.compile(rf"(?i)\b(?:{_CUE})\s+((?:(?:rev|dr|prof|mr|mrs|ms)\.?\s+)?)([^\W\d_]{{2,}})((?:\s+[^\W\d_]\.)?)\s+([^\W\d_][^\W\d_'’]+(?:-[^\W\d_]+)?)")
_BEFORE = re.compile(rf"(?:(?<!\w){_TITLE}\s+|(?i:(?<!\w){_ROLE}),?\s+)$")
_FAMILY = re.compile(rf"[\w'’\-]{{2,}}(?:{FAMILY_ENDS})$", re.I)
_SIGNED = re.compile(r"(?:^|[\r\n]|[.!?…]\s)\s*[-–—~]{1,2}\s*$")
# Shapes of names in other scripts.
_CYRILLIC = re.compile(
    r"(?<![\w])([А-ЯЁІЇЄ][а-яёіїє]{1,}(?:-[А-ЯЁ][а-яё]+)?)((?:\s+[А-ЯЁ][а-яё]+(?:вич|вна|ична|инична|ич|вича|вне|вной)(?!\w))?)\s+([А-ЯЁІЇЄ][а-яёіїє]+(?:-[А-ЯЁ][а-яё]+)?)(?!\w)"
)
_CYRILLIC_CUE = re.compile(r"(?i)(?:зовут|моё имя|мое имя|с уважением,?|подпись:?|г-н|г-жа|господин|госпожа|товарищ|мой друг|моя подруга|наш редактор|фотограф|автор|певица|певец)\s*[-–—:]?\s*$")
_CYRILLIC_FAMILY = re.compile(r"(?:ов|ова|ев|ева|ёв|ёва|ин|ина|ын|ына|ский|ская|цкий|цкая|ской|енко|чук|юк|ян|дзе|швили|ович|евич)(?:а|у|ым|ом|ой|е)?$")
_CYRILLIC_PLACE = re.compile(r"(?:\bг\.|ул\.?|улиц\w+|город\w*|площад\w+|пл\.|театр\w*|клуб\w*|кафе|бар\w*|групп\w+|станци\w+|парк\w*|рек\w+)\s*[«\"]?$", re.I)
_CYRILLIC_GIVEN = set(
    """александр александра алексей алёна алина анастасия анатолий андрей анна антон аркадий борис вадим валентин валентина валерий варвара василий вера виктор виктория виталий владимир владислав вячеслав
    галина геннадий георгий григорий дарья денис дмитрий евгений евгения екатерина елена елизавета зинаида зоя иван игорь илья ирина кирилл константин ксения лариса леонид лидия людмила любовь максим маргарита
    марина мария михаил надежда наталья наталия никита николай нина оксана олег ольга павел пётр петр полина раиса роман руслан светлана семён сергей софия софья станислав степан тамара татьяна тимур фёдор юлия юрий яков яна ярослав""".split()
)
_GREEK = re.compile(r"(?<!\w)([Α-ΩΆΈΉΊΌΎΏ][α-ωάέήίόύώϊϋΐΰς]+)\s+([Α-ΩΆΈΉΊΌΎΏ][α-ωάέήίόύώϊϋΐΰς]+(?:όπουλος|οπούλου|όπουλο|ίδης|ίδη|ίδου|άδης|άδη|άδου|άκης|άκη|άκος|άτος|έας|έλης|έλλης|ίκας|ιώτης|ιώτη|ίου|ου))(?!\w)")
_GREEK_CUE = re.compile(r"(?i)(?:με λένε|ονομάζομαι|λέγομαι|με εκτίμηση,?|κύριος|κυρία|κ\.|κα)\s+([Α-ΩΆΈΉΊΌΎΏ][α-ωάέήίόύώϊϋΐΰς]+\s+[Α-ΩΆΈΉΊΌΎΏ][α-ωάέήίόύώϊϋΐΰς]+)(?!\w)")
_SURNAMES = "王李张張刘劉陈陳杨楊黄黃赵趙吴吳周徐孙孫马馬朱胡郭何高林罗羅郑鄭梁谢謝宋唐许許韩韓冯馮邓鄧曹彭曾萧肖田董袁潘于蒋蔣蔡余杜叶葉程苏蘇魏吕呂丁任沈姚卢盧姜崔钟鍾谭譚陆陸汪范金石廖贾賈夏韦韋付方白邹鄒孟熊秦邱江尹薛闫段雷侯龙史陶黎贺賀顾顧毛郝龚龔邵万钱錢严嚴"
_HAN_CUE = re.compile(rf"(?:我叫|我的名字是|名叫|姓名[:：]|本人|署名[:：]?|此致[，,\s]*)\s*([{_SURNAMES}][一-鿿]{{1,2}})(?![一-鿿])")
_HAN_TITLE = re.compile(rf"(?<![一-鿿])([{_SURNAMES}][一-鿿]{{1,2}})(?=先生|女士|小姐|老师|老師|教授|医生|醫生)")
_KANA = re.compile(r"(?<![一-鿿ぁ-んァ-ヶー])([一-鿿]{1,3}[\s　]?[一-鿿ァ-ヶーぁ-ん]{1,4})(?=(?:さん|様|氏|先生|君)(?![一-鿿]))")
_KANA_CUE = re.compile(r"(?:私は|わたしは|僕は|名前は)([一-鿿]{2}[\s　]?[一-鿿ぁ-ん]{1,3}?)(?=(?:です|と申します|といいます|と言います))")
_ARABIC_CUE = re.compile(r"(?:اسمي|أدعى|السيد|السيدة|الدكتور|الأستاذ)\s+([\u0621-\u064a]+\s+(?:(?:بن|بنت|أبو|آل)\s+)?[\u0621-\u064a]+)")


def _emails(t: Traced) -> Iterator[tuple[int, int]]:
    at = 0
    while m := _EMAIL.search(t.text, at):
        length = _domain_length(m)
        if length:
            yield m.start(), m.start(2) + length
        at = m.start(2) + length


def _ids(t: Traced) -> Iterator[tuple[int, int]]:
    for cue in _ID_CUE.finditer(t.text):
        v = _ID_VALUE.match(t.text, cue.end())
        if v and sum(c.isdigit() for c in v.group()) >= 5:
            yield v.span()
    for rx in (_SSN, _DNI):
        for m in rx.finditer(t.text):
            yield m.span()


def _addresses(t: Traced) -> Iterator[tuple[int, int]]:
    for rx in _STREETS:
        for m in rx.finditer(t.text):
            yield m.span()


_NO_PHONE = re.compile(r"(?i)(?:isbn|issn|order\s+no\.?|catalog(?:ue)?\s+(?:no\.?|number)|serial|model|invoice|article|since)[\s:#]*$")


def _phones(t: Traced) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(t.text):
        if not _NO_PHONE.search(t.text[max(0, m.start() - 24) : m.start()]):
            yield m.span()


def _no_name(word: str, others: set[str]) -> bool:
    return word.lower() in others or len(word) <= 2


def _latin_names(t: Traced) -> Iterator[tuple[int, int]]:
    text = t.text
    at = 0
    while m := _FULL.search(text, at):
        given, family = m.group(1), m.group(3)
        at = m.start(3)  # the family name may be the given name of the next pair
        if _no_name(family, NOT_FAMILY):
            at = m.end()
            continue
        first = given.split("-")[0].lower()
        known = given.lower() in GIVEN_NAMES or first in GIVEN_NAMES
        shaped = given.lower() not in NOT_GIVEN and (
            _FAMILY.match(family) is not None or _BEFORE.search(text[max(0, m.start() - 80) : m.start()]) is not None
            or (_SIGNED.search(text[max(0, m.start() - 8) : m.start()]) is not None and not text[m.end() :].strip(" .!\r\n"))
        )
        if known or shaped:
            yield m.span()
            at = m.end()
    low = text.lower()
    for m in _CUED.finditer(text) if any(x in low for x in _CUE_SIGNS) else ():
        given, family = m.group(2), m.group(4)
        named = given.lower() in GIVEN_NAMES or given[0].isupper() and family[0].isupper() and given.lower() not in NOT_GIVEN
        if named and not _no_name(family, NOT_FAMILY):
            yield m.start(2), m.end(4)


def _cyrillic_names(text: str) -> Iterator[tuple[int, int]]:
    for m in _CYRILLIC.finditer(text):
        given, patronymic, family = m.groups()
        before = text[max(0, m.start() - 24) : m.start()]
        if patronymic or _CYRILLIC_CUE.search(before):
            yield m.span()
        elif _CYRILLIC_FAMILY.search(family) and given.lower() in _CYRILLIC_GIVEN and not _CYRILLIC_PLACE.search(before):
            yield m.span()


def _greek_names(text: str) -> Iterator[tuple[int, int]]:
    for m in _GREEK.finditer(text):
        if m.group(1).lower() not in _GREEK_WORDS:
            yield m.span()
    for m in _GREEK_CUE.finditer(text):
        yield m.span(1)


#: Words that begin Greek sentences.
_GREEK_WORDS = set("ο η το οι τα των την τον τους τις στο στη στην στον και αλλά αν για από με σε που πως πού πότε γιατί όταν πολύ πάντα χθες σήμερα αύριο εδώ εκεί μια ένας ένα αυτός αυτή αυτό".split())
_SCRIPT_NAMES = (
    (re.compile("[А-я]"), _cyrillic_names), (re.compile("[Α-ω]"), _greek_names),
    (re.compile("[一-鿿]"), lambda text: (m.span(1) for rx in (_HAN_CUE, _HAN_TITLE, _KANA, _KANA_CUE) for m in rx.finditer(text))),
    (re.compile("[\u0621-\u064a]"), lambda text: (m.span(1) for m in _ARABIC_CUE.finditer(text))),
)


def _persons(t: Traced) -> Iterator[tuple[int, int]]:
    yield from _latin_names(t)
    if not t.text.isascii():
        for sign, names in _SCRIPT_NAMES:
            if sign.search(t.text):
                yield from names(t.text)


_DETECTORS = {"email": _emails, "id_number": _ids, "address": _addresses, "phone": _phones, "person": _persons}


def spans(source: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) in source positions, in order and without overlaps."""
    if not isinstance(source, str) or not source:
        return []
    t = normalise(source)
    low = t.text.lower()
    taken: list[tuple[int, int, str]] = []
    for kind in KINDS:
        if not _worth(kind, t.text, low):
            continue
        for a, b in _DETECTORS[kind](t):
            if b <= a:
                continue
            s, e = t.back(a, b)
            while e > s and source[e - 1] in " ,":
                e -= 1
            if all(e <= x or s >= y for x, y, _ in taken):
                taken.append((s, e, kind))
    return sorted(taken)


def redact(source: str | None) -> str | None:
    if not isinstance(source, str):
        return None
    out, at = [], 0
    for s, e, kind in spans(source):
        out += [source[at:s], PLACEHOLDER[kind]]
        at = e
    return "".join([*out, source[at:]])


FIELDS = ("text", "name")


def found_spans(comments: DataFrame) -> DataFrame:
    """(comment_id, field, kind, start_pos, end_pos) of every piece of personal information."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for field in FIELDS:
                for i, v in zip(pdf["comment_id"], pdf[field], strict=True):
                    rows += [(i, field, k, s, e) for s, e, k in spans(v)]
            yield pd.DataFrame(rows, columns=["comment_id", "field", "kind", "start_pos", "end_pos"])

    rows = spread(comments.select("comment_id", *FIELDS).where("comment_id is not null"), "comment_id")
    return rows.mapInPandas(run, "comment_id bigint, field string, kind string, start_pos int, end_pos int")


def found(comments: DataFrame) -> DataFrame:
    return found_spans(comments).groupBy("comment_id", "field", "kind").agg(F.lit(1)).select("comment_id", "field", "kind")


def redacted(comments: DataFrame) -> DataFrame:
    """(comment_id, name, text) with placeholders; null stays null."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(name=[redact(v) for v in pdf["name"]], text=[redact(v) for v in pdf["text"]])

    rows = spread(comments.select("comment_id", "name", "text"), "comment_id")
    return rows.mapInPandas(run, "comment_id bigint, name string, text string")
