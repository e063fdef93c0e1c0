"""Class-based n-gram scores with exchange clustering (operator 6)."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright.llm.common import Sent, crc_of_id, cut, only, table

#: The most frequent training words are scored from a broadcast dictionary of at most
#: this size; all other words are looked up by a shuffled join.
DICTIONARY = 200_000
#: So many of them are exchanged between classes each on its own, the other words together
#: with those of the same ending, hashed to so many units.
SINGLE_WORDS, ENDINGS, ENDING_BYTES = 1_000, 128, 4
#: Every further word of so many training tokens then gets the class that fits its own
#: neighbours; rarer and unseen words keep that of their ending.
LEAST_COUNT = 2
CLASSES = 64
#: The end of a text as a word; words hold no blank, so none is like it.
END = b" "
DISCOUNT = 0.5


def words_of(text: bytes | None) -> list[bytes]:
    """Words of UTF-8 bytes; bytes.lower() maps A-Z only, bytes.split() splits at \\x20 and \\x09-\\x0D."""
    return text.lower().split() if text else []


def ending(word: bytes) -> int:
    return crc32(word[-ENDING_BYTES:]) % ENDINGS


def ending_sql(word: Column) -> Column:
    return (F.crc32(F.substring(word, -ENDING_BYTES, ENDING_BYTES)) % ENDINGS).cast("int")


class Ids(dict):
    """Word -> number: a dictionary word's rank, or the dictionary's size plus the number of its ending."""

    KEEP = 50_000

    def __init__(self, ranked: list[bytes]):
        super().__init__(zip(ranked, range(len(ranked)), strict=True))
        self.size = len(ranked)

    def __missing__(self, word: bytes) -> int:
        out = self.size + ending(word)
        if len(self) < self.size + self.KEEP:
            self[word] = out
        return out


def texts(docs: DataFrame) -> DataFrame:
    return only(docs, "doc_id", "text").select("doc_id", F.col("text").cast("binary").alias("text"), crc_of_id(F.col("doc_id")).alias("_crc"))


def word_counts(docs: DataFrame) -> DataFrame:
    """(word binary, n): counts of all words and of the end, summed in each task before they are shuffled."""

    def counted(batches: Iterator) -> Iterator:
        import pyarrow as pa

        made: Counter = Counter()
        flush = lambda: pa.RecordBatch.from_arrays([pa.array(list(made), pa.binary()), pa.array(list(made.values()), pa.int64())], ["word", "n"])
        for b in batches:
            for t in b.column("text").to_pylist():
                made.update(words_of(t))
                made[END] += 1
                if len(made) > 400_000:
                    yield flush()
                    made.clear()
        yield flush()

    return docs.select("text").mapInArrow(counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def unit_bigrams(docs: DataFrame, ids: Ids, unit_of: np.ndarray, n_units: int) -> np.ndarray:
    """Counts of neighbouring units over all texts; unit 0 is the end, before a text and after it.

    Each task sums a matrix of n_units squared and sends its entries; sums of them,
    as many at most whatever the corpus, reach the driver.
    """
    sent = Sent(docs.sparkSession, (ids, unit_of))

    def paired(batches: Iterator) -> Iterator:
        import pyarrow as pa

        ids, unit_of = sent.get()
        total = np.zeros(n_units * n_units, dtype=np.int64)
        kept: list[np.ndarray] = []
        size = 0

        def add() -> None:
            nonlocal kept, size
            if kept:
                total[:] += np.bincount(np.concatenate(kept), minlength=len(total))
            kept, size = [], 0

        for b in batches:
            for t in b.column("text").to_pylist():
                ws = words_of(t)
                units = np.zeros(len(ws) + 2, dtype=np.int64)
                units[1:-1] = unit_of[np.fromiter(map(ids.__getitem__, ws), np.int64, len(ws))]
                kept.append(units[:-1] * n_units + units[1:])
                size += len(ws) + 1
                if size > 1_000_000:
                    add()
        add()
        at = np.flatnonzero(total)
        for i in range(0, len(at), 100_000):
            part = at[i : i + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], ["pair", "n"])

    got = docs.select("text").mapInArrow(paired, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(n_units * n_units)
    out[got.column("pair").to_numpy()] = got.column("n").to_numpy()
    return out.reshape(n_units, n_units)


def frequent(counts: DataFrame, most: int) -> DataFrame:
    """The words that can be among the ``most`` frequent ones, and few others.

    Counts are binned by their five leading bits; the words of the lowest bins that
    can't be needed are left out before any sort, so that what a task sends to it
    doesn't grow with the number of tasks.
    """
    low = F.greatest(F.length(F.bin("n")) - F.lit(5), F.lit(0))
    bins = counts.groupBy(F.call_function("shiftleft", F.call_function("shiftright", "n", low), low).alias("least")).agg(F.count("*").alias("v"))
    got, least = 0, 0
    for r in sorted(bins.collect(), key=lambda r: -r["least"]):  # 16 bins for each doubling of the count
        got, least = got + r["v"], r["least"]
        if got >= most:
            break
    return counts.filter(F.col("n") >= least)


def xlogx(a: np.ndarray) -> np.ndarray:
    return a * np.log(np.maximum(a, 1e-300))


def exchange(n: np.ndarray, n_classes: int) -> np.ndarray:
    """The class of each unit, from the units' bigram counts.

    The end has class 0 for itself.  Units start in turn, most frequent first, and
    move one at a time to the class that raises the likelihood of the class bigrams
    most, until a sweep moves none: each move raises it, so this ends.
    """
    size = len(n)
    weight = n.sum(axis=0) + n.sum(axis=1)
    order = [u for u in np.argsort(-weight, kind="stable") if u != 0]
    n_classes = max(2, min(n_classes, size))
    cls = np.zeros(size, dtype=np.int64)
    for k, u in enumerate(order):
        cls[u] = 1 + k % (n_classes - 1)
    member = np.eye(n_classes)[cls]
    m = member.T @ n @ member
    while True:
        moved = 0
        for u in order:
            if not weight[u]:
                continue
            own, old = n[u, u], cls[u]
            right = np.bincount(cls, n[u], n_classes)
            left = np.bincount(cls, n[:, u], n_classes)
            right[old] -= own
            left[old] -= own
            m[old] -= right
            m[:, old] -= left
            m[old, old] -= own
            f = xlogx(m)
            down, across = xlogx(m + right) - f, xlogx(m + left[:, None]) - f
            both = xlogx(np.diag(m) + right + left + own) - np.diag(f)
            gain = down.sum(axis=1) - np.diag(down) + across.sum(axis=0) - np.diag(across) + both
            outs, ins = m.sum(axis=1), m.sum(axis=0)
            gain -= xlogx(outs + right.sum() + own) - xlogx(outs) + xlogx(ins + left.sum() + own) - xlogx(ins)
            gain[0] = -np.inf
            new = int(np.argmax(gain))
            if gain[new] <= gain[old] + 1e-9:
                new = old
            moved += new != old
            cls[u] = new
            m[new] += right
            m[:, new] += left
            m[new, new] += own
        if not moved:
            return cls


@dataclass
class Model:
    """log10 probabilities: of class after class, of words in their class, and the base's."""

    ids: Ids
    class_of: np.ndarray  # by number of Ids
    step: np.ndarray  # [class before, class]
    emit: np.ndarray  # by number; 0 for words outside the dictionary
    base: np.ndarray
    freq: np.ndarray  # of the dictionary's words
    class_tokens: np.ndarray
    class_unknown: np.ndarray  # log10 probability of an unknown word in the class
    tokens: int
    types: int
    discount: float
    end_base: float

    def base_log(self, n: Column) -> Column:
        return F.log10((n + 0.1) / F.lit(self.tokens + 0.1 * (self.types + 1)))


def probabilities(m: np.ndarray, type_count: np.ndarray, discount: float) -> tuple[np.ndarray, np.ndarray]:
    """log10 probabilities of class after class and of an unknown word in each class."""
    in_class = m.sum(axis=0)
    with np.errstate(divide="ignore", invalid="ignore"):
        unknown = np.where((in_class > 0) & (type_count > 0), discount * type_count / in_class, 1.0)
    unknown = np.minimum(unknown, 1.0)
    uni = (in_class + DISCOUNT) / (in_class.sum() + DISCOUNT * len(m))
    outs = m.sum(axis=1, keepdims=True)
    spread = DISCOUNT * (m > 0).sum(axis=1, keepdims=True)
    step = np.where(outs > 0, (np.maximum(m - DISCOUNT, 0) + spread * uni) / np.maximum(outs, 1), uni)
    return np.log10(step), np.log10(unknown)


def train(docs: DataFrame, counts: DataFrame, n_classes: int = CLASSES, dictionary: int = DICTIONARY) -> Model:
    """Learn classes and probabilities from documents and their word counts, words outside the singles by ending."""
    whole = counts.agg(
        F.sum("n").alias("tokens"), F.count("*").alias("types"), F.count(F.when(F.col("n") == 1, 1)).alias("n1"),
        F.count(F.when(F.col("n") == 2, 1)).alias("n2"), F.sum(F.when(F.col("word") == F.lit(END), F.col("n"))).alias("ends"),
    ).collect()[0]
    tokens, types, ends = int(whole["tokens"] or 0), int(whole["types"]), int(whole["ends"] or 0)
    top = frequent(counts.filter(F.col("word") != F.lit(END)), dictionary).orderBy(F.desc("n"), "word").limit(dictionary).toArrow()
    ranked = [bytes(w) for w in top.column("word").to_pylist()]
    freq = top.column("n").to_numpy().astype(float)
    order = sorted(range(len(ranked)), key=lambda i: (-freq[i], ranked[i]))
    ranked, freq = [ranked[i] for i in order], freq[order]
    ids = Ids(ranked)
    singles = min(SINGLE_WORDS, len(ranked))
    n_units = 1 + singles + ENDINGS
    unit_of = np.empty(len(ranked) + ENDINGS, dtype=np.int64)
    unit_of[:singles] = 1 + np.arange(singles)
    unit_of[singles : len(ranked)] = [1 + singles + ending(w) for w in ranked[singles:]]
    unit_of[len(ranked) :] = 1 + singles + np.arange(ENDINGS)
    n = unit_bigrams(docs, ids, unit_of, n_units)
    cls = exchange(n, n_classes)
    k = int(cls.max()) + 1
    member = np.eye(k)[cls]
    m = member.T @ n @ member

    types_of = np.zeros(n_units)
    types_of[0], types_of[1 : 1 + singles] = 1, 1
    by_ending = counts.filter(F.col("word") != F.lit(END)).groupBy(ending_sql(F.col("word")).alias("e")).agg(F.count("*").alias("v")).collect()
    for r in by_ending:  # ENDINGS rows
        types_of[1 + singles + r["e"]] = r["v"]
    for w in ranked[:singles]:
        types_of[1 + singles + ending(w)] -= 1

    discount = float(np.clip(whole["n1"] / max(1, whole["n1"] + 2 * whole["n2"]), 0.1, 0.95))
    step, unknown = probabilities(m, member.T @ types_of, discount)
    in_class = m.sum(axis=0)
    class_of = cls[unit_of]
    pad = np.zeros(ENDINGS)
    return Model(
        ids, class_of, step,
        np.concatenate([np.log10((freq - discount) / np.maximum(in_class[class_of[: len(ranked)]], 1)), pad]),
        np.concatenate([np.log10((freq + 0.1) / (tokens + 0.1 * (types + 1))), pad]), freq,
        in_class, unknown, tokens, types, discount, float(np.log10((ends + 0.1) / (tokens + 0.1 * (types + 1)))),
    )


#: A place in a word's table of neighbours (classes before, then classes after) and its count.
SLOT = np.dtype([("slot", "<u2"), ("n", "<u4")])


def neighbours(docs: DataFrame, model: Model, singles: int) -> DataFrame:
    """(word, seen): counts of the classes before and after each word but the singles, a row per task and word."""
    sent = Sent(docs.sparkSession, (model.ids, model.class_of))
    k = len(model.step)

    def paired(batches: Iterator) -> Iterator:
        import pyarrow as pa

        ids, class_of = sent.get()
        names = list(ids)[: ids.size]
        local: dict[bytes, int] = {}
        kept: list[np.ndarray] = []
        size = 0

        def flush() -> Iterator:
            nonlocal kept, size
            keys, n = np.unique(np.concatenate(kept), return_counts=True)
            owner = keys >> 16
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            cells = np.empty(len(keys), SLOT)
            cells["slot"], cells["n"] = keys & 0xFFFF, n
            known = [*names, *local]
            ends = [*first[1:], len(keys)]
            for i in range(0, len(first), 20_000):
                j = min(i + 20_000, len(first))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([known[w] for w in owner[first[i:j]]], pa.binary()), pa.array([cells[x:y].tobytes() for x, y in zip(first[i:j], ends[i:j], strict=True)], pa.binary())],
                    ["word", "seen"],
                )
            local.clear()
            kept, size = [], 0

        for b in batches:
            for t in b.column("text").to_pylist():
                ws = words_of(t)
                if not ws:
                    continue
                at = np.fromiter(map(ids.__getitem__, ws), np.int64, len(ws))
                cls = np.zeros(len(ws) + 2, dtype=np.int64)
                cls[1:-1] = class_of[at]
                for i in np.flatnonzero(at >= ids.size):
                    at[i] = local.setdefault(ws[i], ids.size + len(local))
                own = at >= singles
                at = at[own] << 16
                kept += [at + cls[:-2][own], at + (k + cls[2:][own])]
                size += len(ws)
                if size > 2_000_000:
                    yield from flush()
        if kept:
            yield from flush()

    return docs.select("text").mapInArrow(paired, "word binary, seen binary")


def word_classes(docs: DataFrame, model: Model, singles: int) -> DataFrame:
    """(word, n, cls) of every training word but the end.

    A word's tables of neighbouring classes are summed over the corpus; it gets the
    class in which its own tokens are likeliest, with the class bigrams of ``model``.
    """
    spark = docs.sparkSession
    sent = Sent(spark, (model.step, model.class_tokens, model.class_of[model.ids.size :]))

    def fitted(batches: Iterator) -> Iterator:
        import pyarrow as pa

        step, class_tokens, of_ending = sent.get()
        k = len(step)
        fit = np.concatenate([step, step.T])

        def judged(words: list[bytes], table: np.ndarray):
            n = table[:, :k].sum(axis=1)
            old = of_ending[[ending(w) for w in words]]
            members = class_tokens + n[:, None] * (np.arange(k) != old[:, None])
            score = table @ fit - n[:, None] * np.log10(np.maximum(members, 1))
            score[:, 0] = -np.inf
            cls = np.where(n >= LEAST_COUNT, score.argmax(axis=1), old)
            return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(n.astype(np.int64)), pa.array(cls.astype(np.int32))], ["word", "n", "cls"])

        last: list[bytes] = []
        rest = np.zeros((0, 2 * k))
        for b in batches:
            if not b.num_rows:
                continue
            rows, seen = b.column("word").to_pylist(), b.column("seen").to_pylist()
            words, row_of = list(last), np.empty(len(rows), np.int64)
            for i, w in enumerate(rows):  # in order of the words
                if not words or words[-1] != w:
                    words.append(w)
                row_of[i] = len(words) - 1
            cells = np.frombuffer(b"".join(seen), SLOT)
            at = np.repeat(row_of, [len(x) // SLOT.itemsize for x in seen]) * (2 * k) + cells["slot"]
            table = np.bincount(at, cells["n"], len(words) * 2 * k).reshape(-1, 2 * k)
            table[: len(last)] += rest
            if len(words) > 1:
                yield judged(words[:-1], table[:-1])
            last, rest = words[-1:], table[-1:]
        if last:
            yield judged(last, rest)

    seen = neighbours(docs, model, singles).repartition("word").sortWithinPartitions("word")
    found = seen.mapInArrow(fitted, "word binary, n long, cls int")
    rows = [(bytearray(w), int(n), int(c)) for w, n, c in zip(list(model.ids)[:singles], model.freq[:singles], model.class_of[:singles], strict=True)]
    return found.unionByName(spark.createDataFrame(rows, "word binary, n long, cls int"))  # SINGLE_WORDS rows


def code_type(k: int) -> tuple[np.dtype, int]:
    """The type of a token's class and the bit that marks an unknown word."""
    kind = np.dtype("u1" if k <= 127 else "<u2")
    return kind, 1 << (8 * kind.itemsize - 1)


def class_rows(docs: DataFrame, table: DataFrame, model: Model) -> DataFrame:
    """Each document's classes in order (``codes``) and the sums that don't depend on class probabilities.

    A text sends a row with what the dictionary gives and a row per other word; the
    first has a key of its own, so that no key is common to many texts.
    """
    top = frequent(table, model.ids.size).orderBy(F.desc("n"), "word").limit(model.ids.size).toArrow()
    cls_of = {bytes(w): c for w, c in zip(top.column("word").to_pylist(), top.column("cls").to_pylist(), strict=True)}
    own = np.array([cls_of[w] for w in list(model.ids)[: model.ids.size]], dtype=np.int64)
    logs = np.log10(np.maximum(model.freq - model.discount, 1e-300))
    kind, flag = code_type(len(model.step))
    sent = Sent(docs.sparkSession, (model.ids, np.append(own, np.zeros(ENDINGS, np.int64)), np.append(logs, np.zeros(ENDINGS)), model.base, model.end_base))
    id_kind = docs.schema["doc_id"].dataType.simpleString()
    known_end = int(model.end_base > np.log10(0.5 / (model.tokens + 0.1 * (model.types + 1))))

    def looked_up(batches: Iterator) -> Iterator:
        import pyarrow as pa

        ids, own, logs, base, end_base = sent.get()
        size = ids.size
        for b in batches:
            rows: list[tuple] = []
            for row, doc, crc, t in zip(*[b.column(c).to_pylist() for c in ("_row", "doc_id", "_crc", "text")], strict=True):
                ws = words_of(t)
                at = np.fromiter(map(ids.__getitem__, ws), np.int64, len(ws))
                places: dict[bytes, list[int]] = {}
                for i in np.flatnonzero(at >= size).tolist():
                    places.setdefault(ws[i], []).append(i)
                known = int((at < size).sum()) + known_end
                head = {"doc_id": doc, "crc": crc, "n": len(ws) + 1, "known": known, "base": float(base[at].sum() + end_base), "exact": float(logs[at].sum()), "codes": own[at].astype(kind).tobytes()}
                rows.append((row, END + str(row).encode(), None, head))
                rows += [(row, w, p, None) for w, p in places.items()]
                if len(rows) > 50_000:
                    yield packed(pa, b.schema.field("doc_id").type, rows)
                    rows = []
            yield packed(pa, b.schema.field("doc_id").type, rows)

    def packed(pa, id_type, rows: list[tuple]):
        head = pa.struct([("doc_id", id_type), ("crc", pa.int64()), ("n", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("exact", pa.float64()), ("codes", pa.binary())])
        cols = list(zip(*rows, strict=True)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.binary(), pa.list_(pa.int32()), head), strict=True)], ["_row", "word", "places", "head"])

    def filled(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            texts = b.column("codes").to_pylist()
            sizes = np.array([len(t) // kind.itemsize for t in texts], dtype=np.int64)
            starts = np.cumsum(sizes) - sizes
            codes = np.frombuffer(b"".join(texts), kind).copy()
            puts = b.column("puts")
            put = puts.flatten().to_numpy(zero_copy_only=False)
            at = np.repeat(starts, puts.value_lengths().to_numpy(zero_copy_only=False)) + (put >> 16)
            codes[at] = put & 0xFFFF
            done = pa.array([codes[x : x + y].tobytes() for x, y in zip(starts, sizes, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], done], [*kept, "codes"])

    parts = docs.withColumn("_row", F.monotonically_increasing_id()).select("_row", "doc_id", "_crc", "text").mapInArrow(
        looked_up, f"_row long, word binary, places array<int>, head struct<doc_id:{id_kind},crc:long,n:long,known:long,base:double,exact:double,codes:binary>"
    )
    ends = F.array(*[F.lit(int(c)) for c in model.class_of[model.ids.size :]])
    code = F.coalesce("cls", F.get(ends, ending_sql(F.col("word"))) + flag)
    n, tf = F.coalesce("n", F.lit(0)), F.size("places")
    each = parts.join(table, "word", "left").select(
        "_row", "head", F.transform("places", lambda p: p.cast("long") * 65536 + code).alias("_put"),
        F.coalesce(F.col("head.known"), F.when(n > 0, tf).otherwise(0)).alias("n_known"),
        F.coalesce(F.col("head.base"), tf * model.base_log(n)).alias("base_score"),
        F.coalesce(F.col("head.exact"), F.when(n > 0, tf * F.log10(n - model.discount)).otherwise(0.0)).alias("exact"),
    )
    rows = each.groupBy("_row").agg(
        F.first("head", ignorenulls=True).alias("_h"), F.flatten(F.collect_list("_put")).alias("puts"),
        F.sum("n_known").alias("n_known"), F.sum("base_score").alias("base_score"), F.sum("exact").alias("exact"),
    )
    kept = ["doc_id", "_crc", "n_tokens", "n_known", "base_score", "exact"]
    rows = rows.select(F.col("_h.doc_id").alias("doc_id"), F.col("_h.crc").alias("_crc"), F.col("_h.n").alias("n_tokens"), "n_known", "base_score", "exact", F.col("_h.codes").alias("codes"), "puts")
    return rows.mapInArrow(filled, f"doc_id {id_kind}, _crc long, n_tokens long, n_known long, base_score double, exact double, codes binary")


def steps(texts: list[bytes], kind: np.dtype, flag: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the texts joined by ends: each place's row, the class before, its own class, and whether its word is unknown."""
    sizes = np.array([len(t) // kind.itemsize + 1 for t in texts], dtype=np.int64)
    end = np.zeros(1, kind).tobytes()
    codes = np.frombuffer(b"".join(x for t in texts for x in (t, end)), kind).astype(np.int64)
    cls = codes & (flag - 1)
    before = np.concatenate([np.zeros(1, np.int64), cls[:-1]])
    return np.repeat(np.arange(len(texts)), sizes), before, cls, codes >= flag


def refit(rows: DataFrame, table: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """log10 of class after class, tokens by class, log10 of an unknown word by class; from the classes of all training words."""
    k = len(model.step)
    kind, flag = code_type(k)

    def paired(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = np.zeros(k * k, dtype=np.int64)
        for b in batches:
            _, before, cls, _ = steps(b.column("codes").to_pylist(), kind, flag)
            total += np.bincount(before * k + cls, minlength=k * k)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["pair", "n"])

    got = rows.select("codes").mapInArrow(paired, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    m = np.zeros(k * k)
    m[got.column("pair").to_numpy()] = got.column("n").to_numpy()
    m = m.reshape(k, k)
    type_count = np.zeros(k)
    type_count[0] = 1
    for r in table.groupBy("cls").agg(F.count("*").alias("v")).collect():  # a row per class
        type_count[r["cls"]] += r["v"]
    step, unknown = probabilities(m, type_count, model.discount)
    return step, m.sum(axis=0), unknown


def scored(rows: DataFrame, step: np.ndarray, class_tokens: np.ndarray, unknown: np.ndarray) -> DataFrame:
    """The rows of ``class_rows`` with their sums of log10 probabilities."""
    kind, flag = code_type(len(step))
    id_kind = rows.schema["doc_id"].dataType.simpleString()
    share = -np.log10(np.maximum(class_tokens, 1))
    share[0] = 0.0  # the end is the only word of its class
    kept = ["doc_id", "_crc", "n_tokens", "n_known", "base_score"]

    def summed(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            row, before, cls, other = steps(b.column("codes").to_pylist(), kind, flag)
            each = step[before, cls] + np.where(other, unknown[cls], share[cls])
            score = b.column("exact").to_numpy() + np.bincount(row, each, b.num_rows)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], pa.array(score)], [*kept, "score"])

    return rows.mapInArrow(summed, f"doc_id {id_kind}, _crc long, n_tokens long, n_known long, base_score double, score double")


def lm_scores(docs: DataFrame, n_classes: int = CLASSES, dictionary: int = DICTIONARY) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document.

    Learns from the documents whose crc32 of the id is not 0 modulo 10.  Words get
    classes by exchange clustering on bigram counts: the most frequent words each on
    their own, the others together with words of the same ending.  A token's
    probability is that of its class after the class before it (absolute discount,
    backed off to the class's own share) times that of the word in its class
    (absolute discount, whose mass goes to unknown words of the class); text begins
    and finishes with the end, a class of its own.  ``score`` is the sum of log10
    probabilities, ``base_score`` that of add-0.1 word frequencies.

    Null and blank texts are an end alone; a null id has the crc32 of the empty text;
    repeated rows each get a row; without training texts the base is 0 throughout;
    an empty table gives no rows; extra columns are ignored.
    """
    rows = texts(docs)
    learned = rows.filter("_crc % 10 <> 0")
    counts = cut(word_counts(learned))
    model = train(learned, counts, n_classes, dictionary)
    table = cut(word_classes(learned, model, min(SINGLE_WORDS, model.ids.size)))
    coded = cut(class_rows(rows, table, model))
    out = scored(coded, *refit(coded.filter("_crc % 10 <> 0"), table, model))
    return out.select(
        "doc_id", (F.col("_crc") % 10 == 0).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )


def op6_class_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))
