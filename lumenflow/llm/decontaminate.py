"""Benchmark decontamination by winnowing, in DataFrame functions only.

Of every run of consecutive k-gram hashes the least is kept as a fingerprint, in documents
and in benchmark items alike. With k-grams and runs chosen so that ``k + run - 1`` is the
window length, every shared window has a fingerprint on both sides. Hits of the fingerprint
join are extended word by word in both directions and count where at least a window agrees.

Items shorter than the window are one window of their own length; each such length (there
are fewer of them than words in a window) is fingerprinted with a smaller k and run.

Before the join, documents keep only fingerprints that fall on a set bit of a map of the
benchmark's fingerprints; the map's size follows their number, up to 1 MB, and it only spares
work. Benchmarks too large for such a map are joined by the hashes alone first, and words are
attached to the places that are met. The benchmark side is broadcast if its fingerprints and their bytes, which are counted, are few; else the join is salted by
document, as a benchmark passage may occur in a large part of the corpus.

Defined cases: null and empty texts have no words; rows that repeat doc_id and text are one
document; a null doc_id is a document of its own text; work grows linearly with a text's length; items without id count as hits but not
as items; empty tables give no hits; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenflow.llm._common import materialize, text_key

WINDOW = 13
KGRAM = 5
#: Bits of the map for each benchmark fingerprint, and the least and most bits of a map (512 and 131,072 longs).
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 15, 1 << 23
#: Benchmark fingerprints up to this number are broadcast, if the words around them are no more bytes than that.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32 << 20
SALTS = 32

#: The separators of the contract's words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is. Pure ASCII takes the fast built-in."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def _gram(length: int) -> tuple[int, int]:
    """k and the number of k-grams in a run, for windows of ``length`` words."""
    k = min(KGRAM, length)
    return k, length - k + 1


def _kgrams(w: Column, k: int) -> Column:
    """Hashes of all k-grams."""
    return F.when(F.size(w) >= k, F.transform(F.sequence(F.lit(1), F.size(w) - (k - 1)), lambda i: F.xxhash64(F.slice(w, i, k)))).otherwise(F.array().cast("array<bigint>"))


def _minima(h: Column, run: int) -> Column:
    """The least hash of each run."""
    if run == 1:
        return h
    return F.when(F.size(h) >= run, F.transform(F.sequence(F.lit(1), F.size(h) - (run - 1)), lambda i: F.array_min(F.slice(h, i, run)))).otherwise(F.array().cast("array<bigint>"))


def _marked(h: Column, m: Column, run: int) -> Column:
    """h and at of every place whose hash is the least of a run around it: no such run's least hash is above
    its own, so the greatest of them is the hash itself. The work is that of ``run`` steps a place."""
    at = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at")))
    if run == 1:
        return at
    own = lambda x: F.array_max(F.slice(m, F.greatest(x["at"] - (run - 2), F.lit(1)), F.least(x["at"] + 1, F.lit(run)))) == x["h"]
    return F.when(F.size(m) > 0, F.filter(at, own)).otherwise(F.slice(at, 1, 0))


def _with_words(w: Column, places: Column, length: int) -> Column:
    """The places, each with the words around it that a shared window may cover."""
    k, _ = _gram(length)
    around = lambda i: F.transform(F.sequence(F.lit(k - length), F.lit(length - 1)), lambda o: F.get(w, i + o))
    return F.transform(places, lambda x: F.struct(F.lit(length).alias("length"), x["h"].alias("h"), x["at"].alias("at"), around(x["at"]).alias("around")))


def _fingerprints(cut: DataFrame, lengths: list[int]) -> DataFrame:
    """Adds p{length}, the marked places, for each length. k-grams are hashed once for each k."""
    for k in sorted({_gram(n)[0] for n in lengths}):
        cut = cut.withColumn(f"h{k}", _kgrams(F.col("w"), k))
    for n in lengths:
        k, run = _gram(n)
        cut = cut.withColumn(f"m{n}", _minima(F.col(f"h{k}"), run)).withColumn(f"p{n}", _marked(F.col(f"h{k}"), F.col(f"m{n}"), run))
    return cut


def map_bits(fingerprints: int) -> int:
    """The power of two of at least BITS_EACH bits for each fingerprint, within the bounds."""
    return min(max(1 << (BITS_EACH * fingerprints - 1).bit_length(), LEAST_BITS), MOST_BITS)


def benchmark_prints(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """length, h, at, around and item_id of every fingerprint of the benchmark."""
    cut = items.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0).withColumn("length", F.least(F.size("w"), F.lit(window)))
    prints = None
    for length in range(1, window + 1):
        own = _fingerprints(cut.where(F.col("length") == length), [length])
        own = own.select("item_id", F.explode(_with_words(F.col("w"), F.col(f"p{length}"), length)).alias("p")).select("item_id", "p.length", "p.h", "p.at", "p.around")
        prints = own if prints is None else prints.unionByName(own)
    return prints


def _may_hit(prints: DataFrame, length: int, bits: int):
    """A test of fingerprints against a map of the benchmark's, ``bits`` bits as longs."""
    place = lambda h: F.pmod(h, F.lit(bits)).cast("int")
    one = lambda h: F.call_function("shiftleft", F.lit(1).cast("long"), place(h).bitwiseAND(F.lit(63)))
    own = prints.where(F.col("length") == length).select(F.shiftright(place(F.col("h")), 6).alias("word"), one(F.col("h")).alias("bit"))
    held = {r["word"]: r["bits"] for r in own.groupBy("word").agg(F.bit_or("bit").alias("bits")).collect()}  # at most bits / 64 rows
    # one text literal, which the optimizer folds into an array: a literal for each of many longs is slow to plan
    table = F.split(F.lit(",".join(str(held.get(k, 0)) for k in range(bits // 64))), ",").cast("array<bigint>")
    return lambda h: F.get(table, F.shiftright(place(h), 6)).bitwiseAND(one(h)) != 0


_PLACE = "array<struct<length:int,h:bigint,at:int,around:array<string>>>"


def _all_with_words(lengths: list[int]) -> Column:
    if not lengths:
        return F.array().cast(_PLACE)
    return F.flatten(F.array(*[F.when(F.size(f"p{n}") > 0, _with_words(F.col("w"), F.col(f"p{n}"), n)).otherwise(F.array().cast(_PLACE)) for n in lengths]))


def _met_places(marked: DataFrame, prints: DataFrame, lengths: list[int]) -> DataFrame:
    """Places whose hash the benchmark holds, for benchmarks that would fill a map: hashes alone are
    joined first, and only places that are met go back to their document for the words around them.
    Rows that repeat doc_id and text are one document in this."""
    thin = F.flatten(F.array(*[F.transform(f"p{n}", lambda x: F.struct(F.lit(n).alias("length"), x["h"].alias("h"), x["at"].alias("at"))) for n in lengths]))
    rows = marked.select("doc_id", "text_key", F.explode(thin).alias("p")).select("doc_id", "text_key", "p.*")
    met = rows.join(prints.select("length", "h").distinct(), ["length", "h"], "left_semi")
    places = F.collect_set(F.struct("length", "h", "at"))
    back = met.groupBy(F.col("doc_id").alias("own_id"), F.col("text_key").alias("own_key")).agg(places.alias("places"))
    texts = marked.select("doc_id", "text_key", "w").dropDuplicates(["doc_id", "text_key"])
    both = texts.join(back, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("text_key") == F.col("own_key")))
    for n in lengths:
        both = both.withColumn(f"p{n}", F.filter("places", lambda x: x["length"] == n))
    return materialize(both.select("doc_id", "text_key", F.explode(_all_with_words(lengths)).alias("p")).select("doc_id", "text_key", "p.*"))


def _run(flags: Column) -> Column:
    """Length of the run of true values at the end."""
    return F.aggregate(flags, F.lit(0), lambda n, x: F.when(x, n + 1).otherwise(F.lit(0)))


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, text_key, n_words, n_hit, n_items, item_ids (sorted strings) of every document."""
    prints = materialize(benchmark_prints(items, window))
    of_words = F.octet_length(F.concat_ws(" ", "around"))
    found = {r["length"]: r for r in prints.groupBy("length").agg(F.count("*").alias("n"), F.sum(of_words).alias("bytes")).collect()}  # at most ``window`` rows
    cut = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), words(F.col("text")).alias("w"))
    lengths = sorted(found)
    marked = _fingerprints(cut, lengths)
    if any(BITS_EACH * found[n]["n"] > MOST_BITS for n in lengths):
        base = materialize(cut.select("doc_id", "text_key", F.size("w").cast("long").alias("n_words")))
        asked = _met_places(marked, prints, lengths)
    else:
        for n in lengths:
            may = _may_hit(prints, n, map_bits(found[n]["n"]))
            marked = marked.withColumn(f"p{n}", F.filter(f"p{n}", lambda x: may(x["h"])))  # noqa: B023
        base = materialize(marked.select("doc_id", "text_key", F.size("w").cast("long").alias("n_words"), _all_with_words(lengths).alias("hits")))
        asked = base.select("doc_id", "text_key", F.explode("hits").alias("p")).select("doc_id", "text_key", "p.*")
    held = prints.select("length", "h", F.col("around").alias("item_around"), "item_id")
    if sum(r["n"] for r in found.values()) <= BROADCAST_ROWS and sum(r["bytes"] for r in found.values()) <= BROADCAST_BYTES:
        met = asked.join(F.broadcast(held), ["length", "h"])
    else:
        salted = held.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = asked.withColumn("salt", F.pmod(F.xxhash64("doc_id", "text_key", "at"), F.lit(SALTS)).cast("int")).join(salted, ["length", "h", "salt"])
    same = F.zip_with("around", "item_around", lambda a, b: F.coalesce(a == b, F.lit(False)))
    left = F.col("length") - F.least(F.lit(KGRAM), F.col("length"))
    spans = (
        met.withColumn("same", same)
        .withColumn("before", _run(F.slice("same", F.lit(1), left)))
        .withColumn("after", _run(F.reverse(F.slice("same", left + 1, F.col("length")))))
        .where(F.col("before") + F.col("after") >= F.col("length"))
        .select("doc_id", "text_key", F.struct((F.col("at") - F.col("before")).alias("lo"), (F.col("at") + F.col("after")).alias("hi")).alias("span"), F.col("item_id").cast("string").alias("item"))
    )
    rows = base.select("doc_id", "text_key", "n_words", F.lit(None).cast("struct<lo:int,hi:int>").alias("span"), F.lit(None).cast("string").alias("item"))
    both = rows.unionByName(spans.withColumn("n_words", F.lit(None).cast("long")).distinct())
    done = both.groupBy("doc_id", "text_key").agg(F.max("n_words").alias("n_words"), F.sort_array(F.collect_set("span")).alias("spans"), F.array_sort(F.collect_set("item")).alias("item_ids"))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, s: F.struct((a["n"] + F.greatest(s["hi"] - F.greatest(s["lo"], a["end"]), F.lit(0))).alias("n"), F.greatest(a["end"], s["hi"]).alias("end")),
    )["n"]
    return done.select("doc_id", "text_key", "n_words", covered.cast("long").alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"), "item_ids")


def contaminated(report: DataFrame) -> Column:
    """At least a twentieth of the words are hit."""
    return (report["n_hit"] > 0) & (20 * report["n_hit"] >= report["n_words"])


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of documents of which under a twentieth of the words is hit."""
    report = contamination(docs, items, window)
    bad = materialize(report.where(contaminated(report)).select(F.col("doc_id").alias("bad_id"), F.col("text_key").alias("bad_key")))
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["bad_id"]) & (text_key(docs["text"]) == bad["bad_key"]), "left_anti")
