"""SimHash fingerprints: weighted term hashes vote on signed bits; permuted block tables find near ones.

Everything is a column expression. Terms are runs of three words, and the shorter runs at the end
of a text; a term's weight grows with its length. Null text counts as empty; a text without words
has fingerprint 0; equal texts have equal fingerprints; texts are taken whole, in chunks of terms;
rows that tie in every column used are interchangeable; an empty table gives an empty table.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyguard.llm.common import once, whole_text

BITS = 64
# A bigint sums three bits' votes in lanes of 21 bits; a chunk's weights fit a lane.
LANE = 21
MAX_WEIGHT, CHUNK_TERMS = 15, 100_000
MASK = 1 | 1 << LANE | 1 << 2 * LANE
# Ranges of document ids in which the next document is looked up.
RANGES = 1024


def words(text: Column) -> Column:
    return F.split(F.btrim(F.lower(text), F.lit(" \t\n\r\x0b\x0c")), r"[\x20\x09-\x0D]+")


def _vote_sums(h: Column, weight: Column) -> list[Column]:
    lanes = [
        F.sum(F.shiftright(h, j).bitwiseAND(F.lit(MASK)) * weight).alias(f"v{j}") for j in range(LANE)
    ]
    return [*lanes, F.sum(F.shiftrightunsigned(h, BITS - 1) * weight).alias(f"v{LANE}")]


def fingerprints(rows: DataFrame, keys: list[str], text: str, out: str) -> DataFrame:
    """One row per distinct ``keys`` with the fingerprint of ``text`` as a bigint.

    ``keys`` must tell the rows apart. Where the rows are already dealt out by one of the keys,
    the votes need no shuffle.
    """
    split = once(rows.select(*keys, F.col(text).alias("_words")), _words=words(F.col("_words")))
    n = F.size("_words")
    parts = ["_words", F.slice("_words", F.lit(2), n), F.slice("_words", F.lit(3), n)]
    runs = split.select(*keys, F.posexplode(F.arrays_zip(*parts)).alias("_at", "_t"))
    a, b, c = (F.col("_t").getField(x) for x in ("_words", "1", "2"))
    length = F.length(F.concat_ws("", a, b, c))
    weight = F.when(length == 0, 0).otherwise(F.least(F.lit(MAX_WEIGHT), 1 + F.floor(length / 3).cast("int")))
    voted = runs.select(
        *keys,
        F.floor(F.col("_at") / CHUNK_TERMS).alias("_chunk"),
        F.xxhash64(a, b, c).alias("_h"),
        weight.cast("bigint").alias("_w"),
    )
    sums = voted.groupBy(*keys, "_chunk").agg(F.sum("_w").alias("_w"), *_vote_sums(F.col("_h"), F.col("_w")))
    lane = F.lit((1 << LANE) - 1)
    bits = [F.shiftright(F.col(f"v{j % LANE}"), LANE * (j // LANE)).bitwiseAND(lane) for j in range(3 * LANE)]
    bits.append(F.col(f"v{LANE}"))
    totals = sums.groupBy(*keys).agg(F.sum("_w").alias("_w"), *[F.sum(b).alias(f"b{j}") for j, b in enumerate(bits)])
    value = F.lit(0).cast("bigint")
    for j in range(BITS):
        one = F.lit(1 << j if j < BITS - 1 else -(1 << j)).cast("bigint")
        value = value.bitwiseOR(F.when(F.col(f"b{j}") * 2 > F.col("_w"), one).otherwise(F.lit(0).cast("bigint")))
    return totals.select(*keys, value.alias(out))


def hex16(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, 0 for opposite ones."""
    return F.lit(1.0) - distance(a, b) / F.lit(float(BITS))


def _range_of(key: Column, bounds: list[int]) -> Column:
    """How many bounds are at or below the key, looked up in two steps."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    coarse, fine = F.lit(bounds[::step]).cast("array<bigint>"), F.lit(bounds).cast("array<bigint>")
    block = F.size(F.filter(coarse, lambda x: x <= key))
    first = F.greatest(block - 1, F.lit(0)) * step
    return first + F.size(F.filter(F.slice(fine, first + 1, F.lit(step)), lambda x: x <= key))


def in_order(docs: DataFrame, key: str, text: str, ranges: int = RANGES) -> DataFrame:
    """``docs`` in ranges of (key, text), each row with its number in the range.

    A range (``_range``) also gets copies (``_copy`` 1) of the first documents of the range behind
    it, the last range those of the first one, so the next document of any row is the next row
    (``_row``) of its range. Null keys come first.
    """
    order = F.coalesce(F.col(key), F.lit(-(1 << 63)))
    shares = [i / ranges for i in range(1, ranges)]
    cuts = docs.agg(F.percentile_approx(order, shares, 20 * ranges).alias("cuts")).first()["cuts"]
    place = _range_of(F.col("_order"), sorted(set(cuts or [])))
    placed = docs.select(order.alias("_order")).select("_order", place.alias("_range"))
    # At most `ranges` rows.
    firsts = sorted(tuple(r) for r in placed.groupBy("_range").agg(F.min("_order")).collect())
    ahead = F.lit(None).cast("int")
    if firsts:
        known = F.array(*[F.lit(k).cast("bigint") for _, k in firsts])
        target = F.array(*[F.lit(r) for r, _ in [firsts[-1], *firsts[:-1]]])
        at = F.array_position(known, F.col("_order")).cast("int")
        ahead = F.when(at > 0, F.get(target, at - 1))
    homes = F.filter(
        F.array(
            F.struct(place.alias("_range"), F.lit(0).alias("_copy")),
            F.struct(ahead.alias("_range"), F.lit(1).alias("_copy")),
        ),
        lambda home: home["_range"].isNotNull(),
    )
    dealt = docs.withColumn("_order", order).select("*", F.inline(homes))
    following = Window.partitionBy("_range").orderBy("_copy", "_order", text)
    return dealt.withColumn("_row", F.row_number().over(following)).drop("_order")


def edited(text: Column, following: Column) -> Column:
    """The text with its last quarter replaced by as much of the start of the next one."""
    quarter = F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - quarter), F.substring(following, F.lit(1), quarter))


def compare_with_edit(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: fingerprints of its text, of the edited text, and of the next document's.

    Columns: the key, n_chars, edited_sha256, and as bigint fingerprint, edited_fingerprint and
    next_fingerprint. The texts are shuffled once, into ranges of keys; all else happens there.
    """
    rows = in_order(docs.select(F.col(key).alias("_key"), whole_text(text).alias("_own")), "_key", "_own")
    onward = Window.partitionBy("_range").orderBy("_row")
    paired = rows.withColumn("_next", F.lead("_own", 1, "").over(onward))
    paired = once(paired, _new=edited(F.col("_own"), F.col("_next"))).drop("_next")
    paired = once(paired, n_chars=F.length("_own").cast("bigint"), edited_sha256=F.sha2("_new", 256))
    keys = ["_range", "_row", "_copy", "_key", "n_chars", "edited_sha256"]
    which = F.array(
        F.struct(F.lit(0).alias("_which"), F.col("_own").alias("_text")),
        F.struct(F.lit(1).alias("_which"), F.col("_new").alias("_text")),
    )
    prints = fingerprints(paired.select(*keys, F.inline(which)), [*keys, "_which"], "_text", "_fp")
    both = prints.groupBy(*keys).agg(
        F.max(F.when(F.col("_which") == 0, F.col("_fp"))).alias("fingerprint"),
        F.max(F.when(F.col("_which") == 1, F.col("_fp"))).alias("edited_fingerprint"),
    )
    done = both.withColumn("next_fingerprint", F.lead("fingerprint").over(onward)).filter("_copy = 0")
    return done.withColumnRenamed("_key", key).drop("_range", "_row", "_copy")


def _tables(fingerprint: Column, radius: int, blocks: int) -> Column:
    """One struct (table, key) per permuted table: the bits of all but ``radius`` of the blocks."""
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    entries = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in chosen)
        signed = mask - (1 << BITS) if mask >> (BITS - 1) else mask
        key = fingerprint.bitwiseAND(F.lit(signed).cast("bigint"))
        entries.append(F.struct(F.lit(number).alias("_table"), key.alias("_block")))
    return F.array(*entries)


def near(queries: DataFrame, prints: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """All pairs (query, fingerprint, distance) of different texts' fingerprints within ``radius`` bits.

    Both tables have a bigint column ``fingerprint``; repeated values and nulls count once and not
    at all. Two fingerprints within the radius agree in all but ``radius`` blocks at least, so they
    meet in one of the tables.
    """
    if not 0 <= radius < blocks:
        raise ValueError("more blocks than the radius are needed")

    def entries(df: DataFrame, name: str) -> DataFrame:
        known = df.select(F.col("fingerprint").alias(name)).filter(F.col(name).isNotNull()).distinct()
        return known.select(name, F.inline(_tables(F.col(name), radius, blocks)))

    met = entries(queries, "query").join(entries(prints, "fingerprint"), ["_table", "_block"])
    found = met.withColumn("distance", distance(F.col("query"), F.col("fingerprint")))
    return found.filter(F.col("distance") <= radius).select("query", "fingerprint", "distance").distinct()


def near_documents(queries: DataFrame, prints: DataFrame, key: str = "doc_id", radius: int = 3) -> DataFrame:
    """One row per fingerprint of ``prints``: fingerprint, n_docs, representative (its smallest key), and for
    those of ``queries``, some of the documents of ``prints``, n_near and near, else null.

    ``n_near`` counts the documents within the radius but one, the query itself; ``near`` has the
    representatives of their fingerprints, nearest first, the query's own where other documents share it
    (no more than there are values within the radius).
    """
    members = prints.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n_docs"), F.min(key).alias("representative"))
    met = near(queries, prints, radius).join(members, "fingerprint")
    alone = (F.col("distance") == 0) & (F.col("n_docs") == 1)
    match = F.struct("distance", F.col("representative").alias(key), "n_docs")
    found = met.groupBy(F.col("query").alias("fingerprint")).agg(
        (F.sum("n_docs") - 1).alias("n_near"),
        F.sort_array(F.collect_list(F.when(~alone, match))).alias("near"),
    )
    return members.join(found, "fingerprint", "left")
