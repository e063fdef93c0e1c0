"""Word lists and tables that results depend on."""

# Legal forms of company names.
LEGAL = (
    "inc incorporated corp corporation co company llc pllc llp lp ltd limited plc pc pa esq "
    "pvt private praivet praibhet prayvet "
    "sa sas sasu sarl eurl sci snc scp selarl scop sca cie societe ste association ets etablissements "
    "gmbh ag bv nv"
).split()
# Words dropped from the core of a name.
DROPPED = ["the", "and"]
# Endings of domains' host names, tried in this order.
DOMAIN_TAILS = ["pvtltd", "privatelimited", "limited", "ltd", "llc", "inc", "corp", "co"]
# Top-level domains.
DOMAINS = ["co.in", "org.in", "net.in", "com", "net", "org", "in", "co", "fr", "biz", "info", "us", "io"]
# Digits that stand for letters.
DIGIT_LETTERS = {"0": "o", "1": "l", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b"}

# States and their codes.
STATES = {
    "alabama": "al", "alaska": "ak", "arizona": "az", "arkansas": "ar", "california": "ca", "colorado": "co",
    "connecticut": "ct", "delaware": "de", "florida": "fl", "georgia": "ga", "hawaii": "hi", "idaho": "id",
    "illinois": "il", "indiana": "in", "iowa": "ia", "kansas": "ks", "kentucky": "ky", "louisiana": "la",
    "maine": "me", "maryland": "md", "massachusetts": "ma", "michigan": "mi", "minnesota": "mn", "mississippi": "ms",
    "missouri": "mo", "montana": "mt", "nebraska": "ne", "nevada": "nv", "new hampshire": "nh", "new jersey": "nj",
    "new mexico": "nm", "new york": "ny", "north carolina": "nc", "north dakota": "nd", "ohio": "oh", "oklahoma": "ok",
    "oregon": "or", "pennsylvania": "pa", "rhode island": "ri", "south carolina": "sc", "south dakota": "sd",
    "tennessee": "tn", "texas": "tx", "utah": "ut", "vermont": "vt", "virginia": "va", "washington": "wa",
    "west virginia": "wv", "wisconsin": "wi", "wyoming": "wy", "district of columbia": "dc", "puerto rico": "pr",
    "andhra pradesh": "ap", "arunachal pradesh": "ar", "assam": "as", "bihar": "br", "chhattisgarh": "cg", "goa": "ga",
    "gujarat": "gj", "haryana": "hr", "himachal pradesh": "hp", "jharkhand": "jh", "karnataka": "ka", "kerala": "kl",
    "madhya pradesh": "mp", "maharashtra": "mh", "manipur": "mn", "meghalaya": "ml", "mizoram": "mz", "nagaland": "nl",
    "odisha": "od", "orissa": "od", "punjab": "pb", "rajasthan": "rj", "sikkim": "sk", "tamil nadu": "tn",
    "telangana": "tg", "tripura": "tr", "uttar pradesh": "up", "uttarakhand": "uk", "west bengal": "wb", "delhi": "dl",
    "jammu and kashmir": "jk", "ladakh": "la", "puducherry": "py", "pondicherry": "py", "chandigarh": "ch",
    "andaman and nicobar islands": "an", "gujrat": "gj", "krnatk": "ka", "mdhy prdes": "mp",
}
STATE_CODES = sorted({*STATES.values(), "ts"})
# Canonical forms of address words.
ADDRESS_FORMS = {
    "road": "rd", "street": "st", "str": "st", "drive": "dr", "circle": "cir", "lane": "ln", "court": "ct",
    "avenue": "ave", "av": "ave", "boulevard": "blvd", "bd": "blvd", "place": "pl", "parkway": "pkwy", "highway": "hwy",
    "terrace": "ter", "square": "sq", "suite": "ste", "apartment": "apt", "floor": "fl", "flr": "fl", "building": "bldg",
    "north": "n", "south": "s", "east": "e", "west": "w", "northeast": "ne", "northwest": "nw", "southeast": "se",
    "southwest": "sw", "near": "nr", "opposite": "opp", "behind": "bhnd", "beside": "bsd", "adjacent": "adj",
    "township": "twp", "mount": "mt", "route": "rte", "sector": "sec", "chemin": "ch", "impasse": "imp",
    "allee": "allee", "quai": "quai",
}
# Words that mark a street, words without meaning, and landmark markers.
STREET_WORDS = "rd st dr cir ln ct ave blvd pl pkwy hwy ter sq way rue chemin allee impasse quai cr rte main ch imp".split()
ADDRESS_NOISE = ["no", "unit", "hno"]
LANDMARKS = ["nr", "opp", "bhnd", "bsd", "adj"]

# Words that don't tell names or streets apart in blocking keys.
STOP_WORDS = (
    "the and inc ltd corp llc pvt for new co company group services private limited enterprises solutions "
    "technologies holdings industries association sarl sas eurl sa sasu sci"
).split()
GENERIC_WORDS = (
    "enterprises solutions technologies services group industries holdings consulting properties management "
    "associates partners ventures global international systems agency logistics products marketing center "
    "store shop care restaurant cafe grill hotel"
).split()
STREET_NOISE = "road street st rd ave lane dr near opp fl floor block bldg plot shop hn".split()

# Expansions of the older cleaner, applied in this order.
NAME_EXPANSIONS = [
    ("corp", "corporation"), ("inc", "incorporated"), ("ltd", "limited"), ("pvt", "private"), ("co", "company"),
    ("llc", "limited liability company"), ("dept", "department"), ("mfg", "manufacturing"), ("intl", "international"),
    ("assoc", "association"), ("&", " and "),
]
ADDRESS_EXPANSIONS = [
    ("st", "street"), ("rd", "road"), ("ave", "avenue"), ("blvd", "boulevard"), ("ln", "lane"), ("dr", "drive"),
    ("hwy", "highway"), ("ste", "suite"), ("apt", "apartment"), ("fl", "floor"), ("pl", "place"), ("pkway", "parkway"),
    ("pkwy", "parkway"), ("near", "near"), ("opp", "opposite"),
]

# Romanisation of a Brahmic letter by its place in its Unicode block.
BRAHMIC = {
    0x01: "m", 0x02: "m", 0x03: "h", 0x05: "a", 0x06: "a", 0x07: "i", 0x08: "i", 0x09: "u", 0x0A: "u", 0x0B: "r",
    0x0C: "l", 0x0D: "e", 0x0E: "e", 0x0F: "e", 0x10: "ai", 0x11: "o", 0x12: "o", 0x13: "o", 0x14: "au", 0x15: "k",
    0x16: "kh", 0x17: "g", 0x18: "gh", 0x19: "n", 0x1A: "c", 0x1B: "ch", 0x1C: "j", 0x1D: "jh", 0x1E: "n", 0x1F: "t",
    0x20: "th", 0x21: "d", 0x22: "dh", 0x23: "n", 0x24: "t", 0x25: "th", 0x26: "d", 0x27: "dh", 0x28: "n", 0x29: "n",
    0x2A: "p", 0x2B: "ph", 0x2C: "b", 0x2D: "bh", 0x2E: "m", 0x2F: "y", 0x30: "r", 0x31: "r", 0x32: "l", 0x33: "l",
    0x34: "l", 0x35: "v", 0x36: "s", 0x37: "s", 0x38: "s", 0x39: "h", 0x3C: "", 0x3D: "", 0x3E: "a", 0x3F: "i",
    0x40: "i", 0x41: "u", 0x42: "u", 0x43: "r", 0x44: "r", 0x45: "e", 0x46: "e", 0x47: "e", 0x48: "ai", 0x49: "o",
    0x4A: "o", 0x4B: "o", 0x4C: "au", 0x4D: "", 0x5F: "y",
}
BRAHMIC_BLOCKS = [0x0900, 0x0980, 0x0A00, 0x0A80, 0x0B00, 0x0B80, 0x0C00, 0x0C80, 0x0D00]
# Letters of further scripts in Latin letters, in the order of the alphabets.
CYRILLIC = dict(zip(
    "абвгдеёжзийклмнопрстуфхцчшщъыьэюяіїєґ",
    "a b v g d e yo zh z i y k l m n o p r s t u f kh ts ch sh shch  y  e yu ya i yi ye g".split(" "), strict=True,
))
GREEK = dict(zip(
    "αβγδεζηθικλμνξοπρσςτυφχψωάέήίόύώϊϋ",
    "a v g d e z i th i k l m n x o p r s s t y f ch ps o a e i i o y o i y".split(" "), strict=True,
))
ARABIC = dict(zip("ابتثجحخدذرزسشصضطظعغفقكلمنهويءآأإةىپچژگ", "a b t th j h kh d dh r z s sh s d t z a gh f q k l m n h w y  a a i a a p ch zh g".split(" "), strict=True))
HEBREW = dict(zip("אבגדהוזחטיךכלםמןנסעףפץצקרשת", "a b g d h v z h t y k k l m m n n s a p p ts ts k r sh t".split(" "), strict=True))
# Parts of Korean syllables: first consonants, vowels, last consonants.
HANGUL = (
    "g kk n d tt r m b pp s ss  j jj ch k t p h".split(" "),
    "a ae ya yae eo e yeo ye o wa wae oe yo u wo we wi yu eu ui i".split(" "),
    " k k ks n nj nh t l lk lm lp ls lt lp lh m p ps t t ng t t k t p t".split(" "),
)

# Scripts told apart, by the regular-expression names of the JVM.
SCRIPTS = (
    "Greek Cyrillic Armenian Hebrew Arabic Devanagari Bengali Gurmukhi Gujarati Oriya Tamil Telugu Kannada Malayalam "
    "Sinhala Thai Lao Tibetan Myanmar Georgian Hangul Ethiopic Khmer Mongolian Hiragana Katakana Bopomofo"
).split()
