"""Benchmark passages found in texts, re-parameterised ones included (operator 3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright.llm.common import cut, only, table, without_ids

#: Canonical tokens in a window; an item with fewer is one window of all its tokens.
WINDOW = 8
#: An item is in a document if so large a share of its windows is.
MIN_SHARE = 0.5
#: Window tables of up to so many rows (24 bytes each) are broadcast, larger ones are joined by shuffle.
BROADCAST_ROWS = 500_000
#: Words that count as units, of English, French and Spanish (German ones have a capital and count as names).
UNITS = (
    "kg g mg lb lbs oz ton tons km m cm mm mile miles ft feet inch inches yard yards l ml liter liters litre litres gallon gallons "
    "hour hours minute minutes second seconds day days week weeks month months year years "
    "dollar dollars cent cents euro euros pound pounds percent degree degrees meter meters metre metres gram grams "
    "heure heures seconde secondes jour jours semaine semaines mois ans année années gramme grammes mètre mètres "
    "hora horas minuto minutos segundo segundos día días semana semanas meses año años gramo gramos metro metros litro litros"
).split()
#: Words that count as numbers, of the four languages; those that are also common words of one of them are left out.
NUMBER_WORDS = (
    "two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty "
    "thirty forty fifty sixty seventy eighty ninety hundred thousand "
    "zwei drei vier fünf sechs sieben acht neun zehn zwölf zwanzig dreißig vierzig fünfzig hundert tausend "
    "deux trois quatre cinq sept huit dix onze douze vingt trente quarante cinquante mille "
    "dos tres cuatro cinco seis siete ocho nueve diez doce veinte treinta cuarenta cincuenta cien mil"
).split()
NAME, NUMBER, SEPARATOR, INITIAL = "\x01", "\x02", "\x03", "\x04"
NAME_AT = r"(?=\p{Lu})(?<=[^.!?:;\s][ \t]{1,3})(\p{Lu}[\p{L}\p{M}'’-]*)"
INITIAL_AT = r"(?=\p{Lu})(?<![\p{L}\p{M}\p{N}\x01-\x03])(?<![\p{L}\p{M}]['’-]{1,2})(\p{Lu}[\p{L}\p{M}'’-]*)"
NUMBER_AT = r"(?=\p{Nd})(?<![\p{L}\p{M}\p{N}\x01-\x03])(\p{Nd}+(?:\x03\p{Nd}+)*)"
GAP = r"[^\p{L}\p{M}\p{N}\x01-\x04]+"


def marked_tokens(text: Column, initials: bool = False) -> Column:
    """Lower-case tokens; names start with \\x01 and numbers with \\x02.

    A name is a word with a capital that doesn't begin a sentence or line; a number
    is a run of digits, with separators between digits.  With ``initials``, other
    words with a capital, which may be names or not, start with \\x04.
    """
    t = F.translate(F.coalesce(text, F.lit("")), NAME + NUMBER + SEPARATOR + INITIAL, "")
    t = F.regexp_replace(t, r"[.,](?=\p{Nd})(?<=\p{Nd}[.,])", SEPARATOR)
    t = F.regexp_replace(t, NAME_AT, NAME + "$1")
    t = F.lower(F.regexp_replace(t, INITIAL_AT, INITIAL + "$1") if initials else t)
    t = F.regexp_replace(t, NUMBER_AT, NUMBER + "$1")
    return F.array_remove(F.split(t, GAP), "")


def bare(token: Column) -> Column:
    """The token without the mark of a word that may be a name."""
    return F.ltrim(token, F.lit(INITIAL))


def placeholder(token: Column) -> Column:
    """The typed placeholder of a name, number or unit; null for other tokens."""
    first = F.substring(token, 1, 1)
    return F.when(first == NAME, "<name>").when((first == NUMBER) | token.isin(NUMBER_WORDS), "<number>").when(token.isin(UNITS), "<unit>")


def canonical(token: Column) -> Column:
    return F.coalesce(placeholder(token), token)


def windows(rows: DataFrame, key: str, sizes: list[int], initials: bool = False) -> DataFrame:
    """(key, at, h): a hash of every window of the given sizes of the array ``_tokens``.

    With ``initials``, a window that holds words marked as such has a second hash, in
    which they are names.  Each token is hashed once; a row per token then reads its
    windows from the array in generated code.
    """
    plain = lambda t: F.xxhash64(canonical(t))
    maybe = lambda t: t.startswith(INITIAL)
    literal = F.transform("_tokens", (lambda t: F.when(maybe(t), plain(bare(t))).otherwise(plain(t))) if initials else plain)
    rows = rows.select(key, "_tokens", literal.alias("_h"))
    if initials:
        name = F.xxhash64(F.lit("<name>"))
        rows = rows.select(key, "_h", F.zip_with("_tokens", "_h", lambda t, h: F.when(maybe(t), name).otherwise(h)).alias("_g"))
    arrays = ["_h", "_g"] if initials else ["_h"]
    # outer: for a plain explode the optimizer adds a filter on the array's size, which makes all tokens twice
    rows = rows.select(key, *arrays, F.posexplode_outer("_h").alias("at", "_t")).filter("at IS NOT NULL")

    def hashed(of: str, n: int) -> Column:
        whole = F.xxhash64(*[F.get(of, F.col("at") + j) for j in range(n)], F.lit(n))
        return F.when(F.col("at") <= F.size(of) - n, whole)

    rows = rows.select(key, "at", *[hashed(x, n).alias(f"{x}{n}") for n in sizes for x in arrays])
    each = [F.col(f"_h{n}") for n in sizes]
    if initials:  # without those that are the same
        each += [F.when(F.col(f"_g{n}") != F.col(f"_h{n}"), F.col(f"_g{n}")) for n in sizes]
    return rows.select(key, "at", F.explode(F.array(*each)).alias("h")).filter("h IS NOT NULL")


def compared(pairs: DataFrame) -> DataFrame:
    """The pairs (``_value`` of an item, ``_other`` in its place) that are slots, names without their marks.

    Two words that only may be names are a slot if either is a sure name at
    another slot of the same item and document.
    """
    kind = lambda c: F.when(F.col(c).startswith(INITIAL), "<name>").otherwise(placeholder(F.col(c)))
    pairs = pairs.filter(kind("_value") == kind("_other"))
    name = lambda c: F.regexp_replace(c, f"^{INITIAL}", NAME)
    unsure = F.col("_value").startswith(INITIAL) & F.col("_other").startswith(INITIAL)
    keys = [c for c in pairs.columns if c not in ("_value", "_other")]
    each = F.struct(name("_value").alias("_value"), name("_other").alias("_other"), unsure.alias("_unsure"))
    pairs = pairs.groupBy(*keys).agg(F.collect_set(each).alias("_all"))  # at most the item's length
    sure = lambda s: F.exists("_all", lambda t: ~t["_unsure"] & ((t["_value"] == s["_value"]) | (t["_other"] == s["_other"])))
    return pairs.select(*keys, F.explode(F.filter("_all", lambda s: ~s["_unsure"] | sure(s))).alias("_s")).select(*keys, "_s._value", "_s._other")


def find_items(docs: DataFrame, items: DataFrame, window: int = WINDOW, min_share: float = MIN_SHARE, broadcast_rows: int = BROADCAST_ROWS, initials: bool = False) -> DataFrame:
    """(doc_id, item_id, share, slots, consistent, leaked) per document and benchmark item that share windows.

    Texts become tokens in which names, numbers and units are typed placeholders,
    so that a question with other names and figures keeps its windows.  Hashes of
    the windows are joined.  ``share`` is the share of the item's windows found in
    the document.  Slots are the item's placeholders that lie in matched windows at
    one place; they are consistent if equal values of the item have equal values in
    the document and unequal ones unequal values.  Every place with the most matches
    or with ``min_share`` of the windows is compared: ``slots`` and ``consistent``
    are those of a consistent place if there is one (then that of most matches, then
    the earliest).  An
    item is ``leaked`` into a document if the share reaches ``min_share`` and the
    slots are consistent.

    With ``initials``, a word with a capital that begins a sentence or line counts
    both as itself and as a name, so that windows over renamed sentence beginnings
    are found.  It is a slot where it, or the word in its place, is a sure name.

    Null and blank texts have no windows; items without a token are never found;
    rows of equal doc_id count as one document, a null one included; an item
    repeated under other ids is found under each; empty tables give no rows.  Work
    is a hash per token and a row per matched window: no pair of texts is compared.
    """
    docs, items = only(docs, "doc_id", "text"), only(items, "item_id", "text").dropDuplicates(["item_id"])
    items = cut(items.filter("item_id IS NOT NULL").select("item_id", marked_tokens(F.col("text"), initials).alias("_tokens")).filter("size(_tokens) > 0"))
    short = [r[0] for r in items.filter(F.size("_tokens") < window).select(F.size("_tokens")).distinct().collect()]  # window - 1 values at most
    known = windows(items.filter(F.size("_tokens") >= window), "item_id", [window], initials)
    for n in short:
        known = known.unionByName(windows(items.filter(F.size("_tokens") == n), "item_id", [n], initials))
    known = cut(known.withColumnRenamed("at", "item_at"))
    per_item = known.groupBy("item_id").agg(F.countDistinct("item_at").alias("n_windows"))
    few = known.count() <= broadcast_rows
    small = F.broadcast if few else (lambda df: df)

    tokens = docs.select("doc_id", marked_tokens(F.col("text"), initials).alias("_tokens"))
    found = windows(tokens, "doc_id", [window, *short], initials).join(small(known), "h")
    found = cut(found.select("doc_id", "item_id", "item_at", (F.col("at") - F.col("item_at")).alias("shift")))

    share = found.groupBy("doc_id", "item_id").agg(F.countDistinct("item_at").alias("_n")).join(small(per_item), "item_id")
    share = share.select("doc_id", "item_id", (F.col("_n") / F.col("n_windows")).alias("share"))
    place = found.groupBy("doc_id", "item_id", "shift").agg(F.countDistinct("item_at").alias("_n"), F.collect_set("item_at").alias("_ats"))
    most = place.groupBy("doc_id", "item_id").agg(F.max("_n").alias("_most")).withColumnsRenamed({"doc_id": "_d", "item_id": "_i"})
    best = place.join(most, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("item_id") == F.col("_i"))).drop("_d", "_i").join(small(per_item), "item_id")
    best = best.filter((F.col("_n") == F.col("_most")) | (F.col("_n") >= min_share * F.col("n_windows")))
    best = cut(best.select("doc_id", "item_id", "shift", "_n", "_ats"))

    near = best.select("doc_id").distinct()
    if near.count() <= broadcast_rows:
        near = F.broadcast(near)
    there = near.withColumnRenamed("doc_id", "_near")
    texts = tokens.join(there, F.col("doc_id").eqNullSafe(F.col("_near")), "left_semi").withColumnRenamed("doc_id", "_doc")
    slots = best.join(small(items.withColumnRenamed("_tokens", "_item")), "item_id")
    slots = slots.withColumn(
        "_slot", F.explode(F.sequence(F.lit(0), F.size("_item") - 1))
    ).withColumn("_value", F.get("_item", F.col("_slot")))
    slots = slots.filter(placeholder(F.col("_value")).isNotNull() | F.col("_value").startswith(INITIAL))
    covered = F.exists("_ats", lambda a: (a <= F.col("_slot")) & (F.col("_slot") < a + window))
    slots = slots.filter(covered).select("doc_id", "item_id", "shift", "_slot", "_value")
    slots = slots.groupBy("doc_id", "item_id", "shift").agg(F.collect_list(F.struct("_slot", "_value")).alias("_slots"))
    slots = slots.join(texts, F.col("doc_id").eqNullSafe(F.col("_doc")))
    slots = slots.select("doc_id", "item_id", F.explode("_slots").alias("_s"), "shift", "_tokens").select(
        "doc_id", "item_id", "shift", F.col("_s._value").alias("_value"), F.get("_tokens", F.col("shift") + F.col("_s._slot")).alias("_other")
    )
    slots = compared(slots)
    slots = slots.groupBy("doc_id", "item_id", "shift").agg(
        F.countDistinct("_value").alias("slots"), F.countDistinct("_other").alias("_o"), F.countDistinct("_value", "_other").alias("_p")
    )
    fine = (F.col("slots") == F.col("_p")) & (F.col("_o") == F.col("_p"))
    slots = slots.select(F.col("doc_id").alias("_d"), F.col("item_id").alias("_i"), F.col("shift").alias("_s"), "slots", fine.alias("_fine"))
    at = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("item_id") == F.col("_i"))
    places = best.join(slots, at & (F.col("shift") == F.col("_s")), "left")
    order = F.struct(F.coalesce("_fine", F.lit(True)).alias("consistent"), "_n", -F.col("shift"), F.coalesce("slots", F.lit(0)).alias("slots"))
    places = places.groupBy("doc_id", "item_id").agg(F.max(order).alias("_b")).select(F.col("doc_id").alias("_d"), F.col("item_id").alias("_i"), "_b.slots", "_b.consistent")
    out = share.join(places, at).drop("_d", "_i")
    return out.withColumn("leaked", (F.col("share") >= min_share) & F.col("consistent"))


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no leaked item, with all their columns."""
    return without_ids(docs, find_items(docs, items, initials=True).filter("leaked"))


def op3_template_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), initials=True).filter("leaked")
