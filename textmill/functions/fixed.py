"""Fixed patterns and word lists used by the cleaners, tokenizer and taggers."""

# fixed values: greeting at the start of a message plus up to four name words
GREETING = (
    r"^((\n*\s*|\n*\S*\s*)(\b|\b\w)(kære|hej|hejsa|hello|hi|dear|til)\s?"
    r"(\w[a-zæøåA-ZÆØÅ\w-]{2,}\s\w[a-zæøåA-ZÆØÅ\w.-]{0,}\s\w[a-zæøåA-ZÆØÅ\w-]{0,}\s\w[a-zæøåA-ZÆØÅ\w-]{2,}"
    r"|\w[a-zæøåA-ZÆØÅ\w-]{2,}\s\w[a-zæøåA-ZÆØÅ\w.-]{0,}\s\w[a-zæøåA-ZÆØÅ\w-]{2,}"
    r"|\w[a-zæøåA-ZÆØÅ\w-]{2,}\s\w[a-zæøåA-ZÆØÅ\w-]{0,}"
    r"|\w[a-zæøåA-ZÆØÅ\w.-]{2,})?(|\n))"
)
# fixed values: the greeting of the older cleaner, up to three name words
GREETING_OLDER = (
    r"^((\n*\s*|\n*\S*\s*)(\b|\b\w)(kære|hej|hejsa|hello|hi|dear|til)\s?"
    r"(\w[a-zæøåA-ZÆØÅ\w-]{2,}\s\w[a-zæøåA-ZÆØÅ\w.-]{0,}\s\w[a-zæøåA-ZÆØÅ\w-]{2,}"
    r"|\w[a-zæøåA-ZÆØÅ\w-]{2,}\s\w[a-zæøåA-ZÆØÅ\w-]{0,}"
    r"|\w[a-zæøåA-ZÆØÅ\w.-]{2,})?(|\n))"
)
# fixed values: sign-offs at which a message is cut, without and with word boundary
SIGN_OFF = (
    r"(med\svenlig\shilsen|de\sbedste\shilsner|bedste\shilsener|venlig\shilsen|hilsen|vh|best\sregards"
    r"|with\skind\sregards|kind\sregards|with\sregards|regards|kh|sende\sfra\smin|sent\sfrom\smy\s)"
)
SIGN_OFF_OLDER = (
    r"\b(med\svenlig\shilsen|de\sbedste\shilsner|venlig\shilsen|mvh|hilsen|vh|best\sregards"
    r"|with\skind\sregards|kind\sregards|with\sregards|regards|sent\sfrom\smy\s)"
)
# fixed values: everything on the line up to these thanks is dropped
THANKS_FOR = (
    r"^.*(tak\sfor\s(din\smail|en\sbehagelig\ssamtale|din\sbesked|svar|din\stilbagemelding|indsendte))\.?"
)
# fixed values: closing phrases, first cut to the end of the line, then removed wishes
CLOSING_TO_LINE_END = (
    r"((tak\sfor\shjælpen|på\sforhånd\stak|på\sforhånd\smange\stak|jeg\sser\sfrem\stil\sat\shøre\sdig"
    r"|håber\sdet\svar\ssvar\snok|mange tak).*)"
)
CLOSING_WISHES = (
    r"((på\sforhånd\stak)|(((jeg|du)\sønske(s|r\s)(dig)?|(hav))\s)?(en\s)?((fortsat|rigtig)\s)?god(t)?\s"
    r"(weekend|dag|ferie|jul|nytår|påske)|(held\sog\slykke\s(fremover)?)|(god\sarbejdslyst).*)"
)

# fixed values: literal replacements of the serving path, in order
LITERALS = (
    ("vedr.", "vedrørende"),
    ("vedr ", "vedrørende "),
    ("mdr.s", "måneders"),
    ("mdr", "måneder"),
    ("medl.", "medlem"),
    ("o.s.v", "og så videre"),
    ("m.m.", "med mere."),
    ("att ", "til "),
    ("att: ", "til "),
    ("att.: ", "til "),
    ("i.f.m", "i forbindelse med"),
    ("ph.d.", "philosophiaedoctor"),
    (" d.", " den"),
    ("ang.", "angående"),
    (" re ", " svar "),
    (" re:", " svar"),
    ("bh.", "bedste hilsener"),
)
# fixed values: the two last entries of the older literal list
LITERALS_OLDER = LITERALS[:-1] + (("/", "/ "), ("email", ""))
# fixed values: the literal list as regular expressions
LITERALS_REGEX = (
    (r"vedr\.", "vedrørende"),
    (r"vedr", "vedrørende"),
    (r"mdr\.s", "måneders"),
    (r"mdr", "måneder"),
    (r"medl\.", "medlem"),
    (r"(o\.s\.v\.|osv\.)", "og så videre"),
    (r"(m\.m\.|mm\.)", "med mere."),
    (r"(att|att\.)", "til"),
    (r"i\.f\.m\.", "i forbindelse med"),
    (r"ph\.d\.", "philosophiaedoctor"),
    (r"\sd\.", " den"),
    (r"ang\.", "angående"),
    (r"[\w\.-]+@[\w\.-]+", ""),
)

# fixed values: example keyword dictionary, canonical term -> variants
KEYWORDS = {
    "hej": ("hej,", "hej."),
    "jeg_har": ("jeg har",),
    "jobnet_dk": ("jobnet",),
    "planlægge": ("planlægger", "planlagt"),
    "supplerende_dagpenge": ("supplerende dagpenge",),
}

# fixed values: normalisation before sentences are split, in order
SENTENCE_NORMALISE = (
    (r"\xa0\n", "\n"),
    (r"\xa0", " "),
    (r"(\r\n)", " "),
    (r"(?=[\?])\?+(\s)?(?<=[\?])", "?\n"),
    (r"\sd\.", "den"),
    (
        r"(?<=den\s\d{2})\.(?=(,|\s))|(?<=den\s\d{1})\.(?=(,|\s))"
        r"|(?<=senest\s\d{2})\.(?=(,|\s))|(?<=senest\s\d{1})\.(?=(,|\s))",
        "",
    ),
    (r"(?<=\s\d{2})\.|(?<=\s\d{1})\.|(?<=\s\d{2}\.\d{2})\.|(?<=\s\d{1}\.\d{2})\.", "-"),
    (r"(?<=(den|til)\s\d{2})\.", "-"),
)

# fixed values: sentence tags; the first pattern that matches at the start wins
SENTENCE_TAGS = (
    (r".*\?", "QUESTION"),
    (r"(til|til\s*\svedkom|kære|hej|hejsa|goddag|godmorgen|hello|hi|dear)", "GREETING"),
    (r".*(bekræfter.*.hermed.*.korrekt)", "CONFIRMATION"),
    (r"\b(tak)", "POSITIVE FEEDBACK"),
    (r".*(håber.*.hjælpe)", "REQUEST HELP"),
    (r".*(kan i tjekke.*\?)", "REQUEST X CHECKED"),
    (r".*(har i mulighed.*\?)", "REQUEST FOR ACTION"),
    (r".*(vedhæft(ede|et|er|e)?|fil(type(r)|er))", "ATTACHMENT"),
    (r"([0-9]+\s){4}|(([0-9]){8})", "PHONE NUMBER"),
    (
        r"(på\sforhånd\stak)|(((jeg|du)\sønske(s|r\s)(dig)?|(hav))\s)?(en\s)?((fortsat|rigtig)\s)?god(t)?\s"
        r"(weekend|dag|ferie|jul|nytår|påske)|(held\sog\slykke\s(fremover)?)|(god\sarbejdslyst)",
        "POLITE ENDING",
    ),
    (
        r"(med\svenlig\shilsen|de\sbedste\shilsner|bedste\shilsener|bedste\shilsner|kærlig\shilsen|dbh"
        r"|venlig\shilsen|mvh|m\.v\.h\.|vh|hilsen|venlig|bh|best\sregards|with\skind\sregards|kind\sregards"
        r"|with\sregards|regards|kh).*",
        "ENDING",
    ),
    (r"(http|ftp|https):\/\/([\w_-]+(?:(?:\.[\w_-]+)+))([\w.,@?^=%&:\/~+#-]*[\w@?^=%&\/~+#-])?", "URL"),
    (r"([\w_-]+(?:(?:\.[\w_-]+)+))([\w.,@?^=%&:\/~+#-]*[\w@?^=%&\/~+#-])?", "URL"),
    (r"(?<=\s)(\w)*@{1}(\w)*\.(\w){2,3}(?=\s)", "EMAIL"),
    (r"\b(ak(\s)?(\d{3}))", "AK FORM"),
    (r"\b(ar(\s)?(\d{3}))", "AR FORM"),
    (r"(sent\sfrom\smy\s).*", "DEVICE INFORMATION"),
)
# fixed values: the older, shorter tag table (no state after an ending)
SENTENCE_TAGS_OLDER = (
    (r".*\?", "QUESTION"),
    (r"(til|kære|hej|hejsa|hello|hi|dear)", "GREETING"),
    (r".*(bekræfter.*.hermed.*.korrekt)", "CONFIRMATION"),
    (r".*(tak)", "POSITIVE FEEDBACK"),
    (r".*(håber.*.hjælpe)", "REQUEST HELP"),
    (r".*(vedhæft*)", "ATTACHMENT"),
    (
        r"(med\svenlig\shilsen|de\sbedste\shilsner|dbh|venlig\shilsen|mvh|hilsen|venlig|best\sregards"
        r"|with\skind\sregards|kind\sregards|with\sregards|regards|kh|sent\sfrom\smy\s).*",
        "ENDING",
    ),
)

# fixed values: the public Danish stopword list (94 words)
DANISH_STOPWORDS = tuple(
    """og i jeg det at en den til er som på de med han af for ikke der var mig sig men et har om vi min havde
    ham hun nu over da fra du ud sin dem os op man hans hvor eller hvad skal selv her alle vil blev kunne ind
    når være dog noget ville jo deres efter ned skulle denne end dette mit også under have dig anden hende
    mine alt meget sit sine vor mod disse hvis din nogle hos blive mange ad bliver hendes været thi jer
    sådan""".split()
)
# fixed values: customer words, greetings, months and weekdays
DOMAIN_STOPWORDS = tuple(
    """akasse aka akademikernes akadk kære hilsen mvh venlig tusind tak januar februar marts april maj juni
    juli august september oktober november december jan feb apr aug sep okt nov dec mandag tirsdag onsdag
    torsdag fredag lørdag søndag an as d esmtps from id in of received the with""".split()
)
# fixed values: two-word and three-word stop phrases
PHRASE_STOPWORDS = (
    "god dag",
    "tak for",
    "om på",
    "dage og",
    "for at",
    "du ikke",
    "af et",
    "bare en",
    "er en",
    "hav en god",
    "tak for dit",
    "en god dag",
    "du er en",
)
# fixed values: words added to the stop list of the serving path
SERVING_STOPWORDS = (
    "kære", "hilsen", "mvh", "venlig", "tusind", "tak", "akasse", "aka", "akademikernes", "!", "akadk",
)
# fixed values: placeholder for a word with non-ASCII characters, and the kept question mark
NON_ASCII_MARK = "qwerty"
KEPT_TOKEN = "?"
