import pytest
from pyspark.sql import functions as F

from linkwright.functions import text as T
from linkwright.operators.normalize import normalize, with_address, with_name

SAME_KEY = [
    ("Maple Harbor Inc", "Harbor Maple Inc"), ("MAPLE HARBOR", "Maple Harbor LLC"), ("Rapid C0pper Smélting (Ltd)", "Rapid Copper Smelting"),
    ("RAPID-COPPER-SMELTING", "Rapid Copper Smelting"), ("Valley Jewe1lers Private [Limited]", "Valley Jewellers Private Limited"),
    ("Nimbus Freight L.L.P.", "Nimbus Freight LLP"), ("silver silver pine ltd", "Silver Pine Ltd"), ("Q+ Mótors", "Q+ Motors"), ("Café des Étoiles (SARL)", "Cafe des Etoiles"),
]


@pytest.fixture(scope="module")
def names(spark):
    def of(*raw):
        df = spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "i int, business_name string")
        return [r.asDict() for r in with_name(df).orderBy("i").collect()]

    return of


@pytest.fixture(scope="module")
def addresses(spark):
    def of(*raw):
        df = spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "i int, business_address string")
        return [r.asDict() for r in with_address(df).orderBy("i").collect()]

    return of


def test_keys_do_not_depend_on_order_legal_form_case_or_noise(names):
    got = names(*[x for p in SAME_KEY for x in p])
    for k, pair in enumerate(SAME_KEY):
        assert got[2 * k]["name_key"] == got[2 * k + 1]["name_key"], pair
    assert got[0]["name_key"] == "harbor maple"


def test_single_names(names):
    a, b, c, d, e, f = names("Valley Jewellers Private Límited", "Q+ Motors", "Etablissements Moreau SARL", "મહાદેવ સ્ટીલ પ્રાઇવેટ લિમિટેડ", None, "The Ltd")
    assert a["name_key"] == "jewellers valley" and b["name_key"] == "motors q" and c["name_key"] == "moreau"
    assert d["name_script"] == "gujarati" and "limited" in d["legal"].split()
    assert e["name_norm"] == e["name_key"] == "" and e["name_is_domain"] == 0
    assert f["name_core"] == "ltd"


def test_domains(names):
    a, b, c, d = names("kaverisports.com", "Kaveri Sports Limited", "https://www.silverpineltd.com/", "rapidcoppersmelting.com")
    assert a["name_compact"] == b["name_compact"] and a["name_is_domain"] == 1
    assert c["name_compact"] == "silverpine" and d["name_compact"] == "rapidcoppersmelting"


def test_digits_in_words(spark):
    cases = {"6arden": "garden", "ye1low": "yellow", "a0b": "a0b", "1234": "1234", "a10b": "a10b", "6a1bc": "6albc", "12th": "12th", "x0yz": "xoyz"}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r[0]: r[1] for r in df.select("t", T.fix_digits(F.col("t"))).collect()} == cases


def test_addresses(addresses):
    same = [
        ("4410 Birchwood Circle, Austin, TX", "Austin, Texas, #4410 Birchwood Cir"), ("77 W Lake Road, Spokane, WA", "77 W Lake Rd, Spokane, Washington"),
        ("Near City Hospital, Temple Road", "Nr City Hospital, Temple Rd"), ("Behind Old Cinema, Park Road", "Bhnd Old Cinema, Park Rd"),
        ("310 Northwest 9th Avenue, Salem, OR", "310 NW 9th Ave, Salem, OR"),
    ]
    got = addresses(*[x for p in same for x in p])
    for k, pair in enumerate(same):
        assert got[2 * k]["addr_key"] == got[2 * k + 1]["addr_key"], pair


def test_address_parts(addresses):
    cases = [
        ("5 Lotus Society, Surat, Gujarat", "state", "gj"), ("5 Lotus Society, Surat, GJ", "state", "gj"),
        ("Madhya Pradesh, 0712, BLOCK-C RIVER VIEW APARTMENT", "numbers", "712"), ("H.No - 41-77/B/3 Gandhi Nagar, Warangal", "house_no", "41"),
        ("23145 Cedar Road, Enid, OK", "postal", ""), ("250 Oak St, Raleigh, NC 27601", "postal", "27601"),
        ("8 Rue Lafayette, 69003 Lyon", "postal", "69003"), ("Kothrud, Pune 411038, Maharashtra", "postal", "411038"),
        ("8 Rue Lafayette, 69003 Lyon", "house_no", "8"), ("", "addr_empty", 1), (None, "addr_empty", 1), ("250 Oak St, Raleigh, NC 27601", "state", ""),
    ]
    for got, (raw, field, want) in zip(addresses(*[c[0] for c in cases]), cases, strict=True):
        assert got[field] == want, (raw, field, got)


def test_unaccent_matches_the_definition(spark):
    import unicodedata

    raw = ["Smélting", "ﬁne Ａ½", "Crème brûlée Ω ḱ", "Straße Ø", "ěščřž", "é̂x", "①②"]
    df = spark.createDataFrame([(r,) for r in raw], "t string")
    for t, got in df.select("t", T.unaccent(F.col("t"))).collect():
        want = "".join(c for c in unicodedata.normalize("NFKD", t) if not "̀" <= c <= "ͯ").lower()
        assert got == want


def test_whole_record(spark):
    df = spark.createDataFrame([("S1-1", "Maple Harbor LLC", "77 W Lake Road, Spokane, WA", " US ", "x")], "entity_id string, business_name string, business_address string, country string, extra string")
    r = normalize(df).collect()[0]
    assert (r.entity_id, r.country, r.house_no, r.state) == ("S1-1", "US", "77", "wa") and len(r) == 16


def test_older_cleaner(spark):
    df = spark.createDataFrame([("Acme & Co, Mfg Corp.", "12 Main St. near Opp Rd", "x 110001 y", "India"), (None, None, None, None)], "n string, a string, p string, c string")
    a, b = df.select(T.clean_name(F.col("n")), T.clean_address(F.col("a")), T.postal_code(F.col("p"), F.col("c"))).collect()
    assert tuple(a) == ("acme and company manufacturing corporation", "12 main street near opposite road", "110001") and tuple(b) == ("", "", None)


def test_blocking_tokens(spark):
    df = spark.createDataFrame([("Lantern Bakery Inc",), ("The Quiet Tailor",), ("a b",), (None,)], "n string")
    got = [tuple(r) for r in df.select(*T.blocking_tokens(F.col("n")).values(), T.name_stem(F.col("n"))).collect()]
    assert got == [("lantern", "bakery", "lan", "lantern bakery"), ("quiet", "tailor", "qui", "the quiet"), ("a", "", "a", "a"), ("", "", "", "")]


def test_ids(spark):
    df = spark.createDataFrame([("S1-204",), ("S2-900000017",), ("S3-31",), ("bad",), (None,)], "i string")
    got = [tuple(r) for r in df.select(T.id_to_number(F.col("i")), T.number_to_id(T.id_to_number(F.col("i")))).collect()]
    assert [g[1] for g in got] == ["S1-204", "S2-900000017", "S3-31", None, None] and got[0][0] == 10**11 + 204
