"""Texts whose five-word shingles are alike: every pair at the threshold is linked, or joined by other links.

The resemblance of two texts is the Jaccard coefficient of their sets of word shingles (A-Z lower-cased; all words joined
if there are fewer than a shingle has). Texts with one set are one class, whose least id stands for all.

MinHash bands come first: a class has 64 least values under 64 hash functions, in 16 bands of four; two texts of
resemblance 0.8 agree in a band with probability 0.41 and in at least one of 16 with 0.9998. A pair goes on if as many of
the 64 values agree as four standard deviations below the threshold allow, and is then checked over the whole sets, so no
pair below the threshold is ever linked. Buckets up to SMALL_BUCKET members give all their pairs. A larger one is dealt
into parts of about PART members by a hash of the id; members are compared with one of their part, and these with one of
theirs, the same ones from bucket to bucket where they can be. Members unlike theirs are placed anew by pairs of bands,
under which few but like texts still meet, and these buckets are treated alike.

The bands can miss pairs, so prefixes follow, which can't. In any one order of all shingles, two sets of n and m shingles
and resemblance t share one of the first n - ceil(t n) + 1 of one and m - ceil(t m) + 1 of the other. All texts are placed
under the shingles of these prefixes, and the pairs of a shingle whose texts the links so far haven't joined are compared
by size and place: o = t (n + m) / (1 + t) shared shingles are needed, so the first shared one has n - o before it at most
in one text and m - o in the other. That gives each text under each shingle a reach, the largest set that it can resemble
by it, and two texts are a pair only if each is within the other's reach. Then parity bits are compared (512 or more, at
least as many as shingles; each shingle in one set only changes one bit, so a pair with more bits apart than shingles may
differ is no link), then the whole sets. The order puts shingles seen in many texts last, so that few texts meet there; it
is estimated, and whatever it is, all links are found.

Lists of more than COMMON texts are first led: each text is compared with the text of the earliest place among those of
about its size, and what links is joined. Of texts that share a passage and nothing else, those that can link to any can
link to the one with the least besides, so these give no further pairs. Then only texts within the reach of a text that they
aren't joined with, which the two largest reaches of different roots for each size tell, meet each other. Texts that are
in each other's reach, alike to a little less than the threshold and unjoined, still grow as their square.
"""

from __future__ import annotations

import math

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import per_text, sliced, staged
from lectern.llm.components import components

SHINGLE, SEED = 5, 42
BANDS, BAND_ROWS = 16, 4
VALUES = BANDS * BAND_ROWS
SMALL_BUCKET, PART = 8, 512
#: Distances to the bands that a band is paired with.
PAIRED = (1, 3, 5, 7)
#: Shingles of which a task looks for repeats at once, the repeats from which a shingle is put last, and words of parity bits of a small set.
HELD, COMMON, PARITY = 500_000, 64, 8
#: Words of the bitmap that tells most texts that aren't asked for.
WORDS = 1 << 17

_RND = np.random.default_rng(SEED)
_FACTORS = _RND.integers(0, 1 << 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RND.integers(0, 1 << 63, VALUES, dtype=np.uint64)


def shingle_set(text: str | None) -> np.ndarray:
    """The distinct XXH64 hashes of a text's shingles, sorted, as signed integers; empty for a text without words."""
    import xxhash

    words = (text or "").encode().lower().split()
    digest = xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        found = [digest(b" ".join(words), SEED)] if words else []
    else:
        found = [digest(s, SEED) for s in map(b" ".join, zip(*(words[k:] for k in range(SHINGLE)), strict=False))]
    return np.unique(np.array(found, dtype=np.uint64).view(np.int64))


def sketch(shingles: np.ndarray) -> tuple[list[int], list[int]]:
    """A key for each band, and the last byte of each of the least values; both empty for an empty set."""
    import xxhash

    if not len(shingles):
        return [], []
    least = np.full(VALUES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 2048):
        part = shingles[at : at + 2048].view(np.uint64)[:, None] * _FACTORS + _SHIFTS
        np.minimum(least, part.min(axis=0), out=least)
    bands = least.astype("<u8").reshape(BANDS, BAND_ROWS)
    keys = np.array([xxhash.xxh64_intdigest(b.tobytes(), k) for k, b in enumerate(bands)], dtype=np.uint64)
    return keys.view(np.int64).tolist(), least.astype(np.uint8).view(np.int8).tolist()


def _met(placed: DataFrame, name: str) -> DataFrame:
    """The rows of keys that several ids have, with their number n."""
    sizes = placed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return staged(placed.join(sizes.hint("merge"), "key"), name)


def _in_place(met: DataFrame) -> DataFrame:
    """(a, b): all pairs of the small buckets."""
    few = met.where(F.col("n") <= SMALL_BUCKET).groupBy("key").agg(F.collect_list("id").alias("ids"))
    pairs = F.expr("flatten(transform(ids, a -> transform(filter(ids, b -> b > a), b -> struct(a, b))))")
    return few.select(F.explode(pairs).alias("p")).select("p.a", "p.b")


def _by_parts(met: DataFrame, name: str) -> DataFrame:
    """(a, b, key): each member a of a large bucket beside the one b that stands for its part, and these beside the first."""
    parts = F.pow(2, F.ceil(F.log2(F.greatest(F.col("n") / PART, F.lit(1))))).cast("long")
    many = met.where(F.col("n") > SMALL_BUCKET).select("id", "key", F.pmod(F.xxhash64("id"), parts).alias("part"), F.xxhash64(F.lit(SEED), "id").alias("drawn"))
    heads = staged(many.groupBy("key", "part").agg(F.min(F.struct("drawn", "id")).alias("head")), name)
    first = heads.groupBy("key").agg(F.min("head").alias("first"))
    within = many.join(heads.hint("merge"), ["key", "part"]).select(F.col("id").alias("a"), F.col("head.id").alias("b"), "key")
    across = heads.join(first.hint("merge"), "key").select(F.col("head.id").alias("a"), F.col("first.id").alias("b"), "key")
    return within.unionByName(across).where("a != b")


def _agreeing(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """pairs with the number of values on which both agree."""
    low_a, low_b = (sketches.select(F.col("id").alias(c), F.col("low").alias(f"low_{c}")).hint("merge") for c in "ab")
    both = pairs.join(low_b, "b").join(low_a, "a")
    same = F.size(F.filter(F.zip_with("low_a", "low_b", lambda x, y: x == y), lambda x: x))
    return both.select(*pairs.columns, same.alias("agreeing"))


def candidates(sketches: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b), a < b, of the ids of (id, keys, low) that may resemble each other, each once."""
    least = math.floor(VALUES * similarity - 4 * math.sqrt(VALUES * similarity * (1 - similarity)))
    met = _met(sketches.select("id", F.posexplode("keys").alias("band", "key")), "bands")
    led = staged(_agreeing(_by_parts(met, "heads").distinct(), sketches), "led")
    unlike = led.where(F.col("agreeing") < least).select(F.col("a").alias("id"), "key").distinct()
    again = met.join(unlike.hint("merge"), ["id", "key"], "left_semi").join(sketches.select("id", "keys").hint("merge"), "id")
    other = [F.col("keys")[F.pmod(F.col("band") + k, F.lit(BANDS))] for k in PAIRED]
    paired = F.array(*(F.xxhash64(F.least("key", o), F.greatest("key", o)) for o in other))
    finer = _met(again.select("id", F.explode(paired).alias("key")).distinct(), "band_pairs")
    rest = _in_place(met).unionByName(_in_place(finer)).unionByName(_by_parts(finer, "finer_heads").select("a", "b"))
    found = _agreeing(rest.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), sketches)
    found = found.unionByName(led.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "agreeing"))
    return staged(found.where(F.col("agreeing") >= least).select("a", "b").distinct(), "candidates")


def prefix(shingles: np.ndarray, similarity: float, common: np.ndarray, rank: np.ndarray) -> tuple[list[int], list[int]]:
    """The first shingles of a sorted set, in the order rare ones by value, then those of the sorted `common` by rank; in these two parts."""
    n = len(shingles)
    if not n:
        return [], []
    length = n - math.ceil(similarity * n - 1e-9) + 1
    at = np.minimum(np.searchsorted(common, shingles), max(len(common) - 1, 0))
    known = common[at] == shingles if len(common) else np.zeros(n, dtype=bool)
    rare = shingles[~known][:length]
    last = shingles[known][np.argsort(rank[at[known]], kind="stable")][: length - len(rare)]
    return rare.tolist(), last.tolist()


def parity(shingles: np.ndarray) -> list[int]:
    """PARITY words, doubled until there are as many bits as shingles, in which a bit is set if an odd number of shingles has it."""
    bits = 64 * PARITY
    while bits < len(shingles):
        bits *= 2
    odd = np.bincount((shingles.view(np.uint64) >> np.uint64(20)).astype(np.int64) % bits, minlength=bits) % 2
    return np.packbits(odd.astype(bool), bitorder="little").view("<i8").tolist()


def _repeated(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that many texts seem to have, sorted, and their place by number. Only the order of shingles depends on it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def counted() -> pa.RecordBatch:
            values, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(values[n > 1]), pa.array(n[n > 1])], names=["shingle", "n"])

        size = 0
        for part in sliced(batches):
            for text in part.column(0).to_pylist():
                held.append(shingle_set(text))
                size += len(held[-1])
                if size >= HELD:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    seen = texts.select("text").mapInArrow(run, "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n"))
    found = seen.where(F.col("n") >= COMMON).toPandas()
    shingles, n = found["shingle"].to_numpy(np.int64), found["n"].to_numpy(np.int64)
    order = np.argsort(shingles)
    shingles, n = shingles[order], n[order]
    rank = np.empty(len(n), dtype=np.int64)
    rank[np.lexsort((shingles, n))] = np.arange(len(n))
    return shingles, rank


def _fitting(a: str, b: str) -> str:
    return f"{a}.root != {b}.root and {a}.n <= {b}.reach and {b}.n <= {a}.reach"


def _folded(words: Column, length: Column, times: int) -> Column:
    """Parity words of a larger set, brought to a smaller one's length by XOR of their halves."""
    for _ in range(times):
        half = (F.size(words) / 2).cast("int")
        halves = F.zip_with(F.slice(words, F.lit(1), half), F.slice(words, half + 1, half), lambda x, y: x.bitwiseXOR(y))
        words = F.when(F.size(words) > length, halves).otherwise(words)
    return words


def _close(pairs: DataFrame, own: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose parity bits, as `own` has them, don't rule a link out."""
    bits_a, bits_b = (own.select(F.col("id").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}")).hint("merge") for c in "ab")
    # lengths are powers of two that grow with the sizes, whose ratio is 1 / similarity at most
    length, times = F.least(F.size("bits_a"), F.size("bits_b")), math.ceil(math.log2(1 / similarity))
    a, b = (_folded(F.col(f"bits_{c}"), length, times) for c in "ab")
    apart = F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    most = (F.col("n_a") + F.col("n_b")) * F.lit((1 - similarity) / (1 + similarity)) + 1e-6
    return pairs.join(bits_b, "b").join(bits_a, "a").where(apart <= most).select(*pairs.columns)


def _listed(own: DataFrame, similarity: float) -> DataFrame:
    """(shingle, id, root, n, pos, reach, few) for each text under each shingle of its prefix that other texts have there too; few: in a list up to COMMON."""
    # most shingles stand in one text: those are left out before anything is joined or gathered
    alone = own.select(F.posexplode("rare").alias("pos", "shingle"), "id").withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("shingle")))
    again = staged(alone.where("_n > 1").select("shingle", "id", "pos", (F.col("_n") <= COMMON).alias("few")), "again").join(own.select("id", "root", "n").hint("merge"), "id")
    common = own.select(F.posexplode("common").alias("_at", "shingle"), "id", "root", "n", F.size("rare").alias("_rare"))
    common = common.select("shingle", "id", "root", "n", (F.col("_rare") + F.col("_at")).alias("pos"), F.lit(False).alias("few"))
    reach = (F.col("n") - F.col("pos")) * F.lit((1 + similarity) / similarity) - F.col("n") + 1e-6
    return staged(common.unionByName(again).withColumn("reach", reach), "listed")


def _led(crowd: DataFrame, similarity: float) -> DataFrame:
    """(a, b, x, y): texts of long lists beside the text of the earliest place of about their size in the list, and the roots of both."""
    sized = crowd.withColumn("size", F.floor(F.log("n") / F.lit(-math.log(similarity))).cast("int"))
    first = sized.groupBy("shingle", "size").agg(F.min(F.struct("pos", "n", "id", "root", "reach")).alias("y"))
    first = first.select("shingle", F.explode(F.array(*(F.col("size") + k for k in (-1, 0, 1)))).alias("size"), "y.*").alias("y")
    met = sized.alias("x").join(first.hint("merge"), F.expr(f"x.shingle = y.shingle and x.size = y.size and {_fitting('x', 'y')}"))
    return met.select(F.expr("least(x.id, y.id) as a"), F.expr("greatest(x.id, y.id) as b"), F.expr("if(x.id < y.id, x.root, y.root) as x"), F.expr("if(x.id < y.id, y.root, x.root) as y")).distinct()


def _in_parts(lists: DataFrame) -> DataFrame:
    """The lists that have several roots, with the number of their parts."""
    sizes = lists.groupBy("shingle").agg(F.count(F.lit(1)).alias("_n"), F.min("root").alias("_x"), F.max("root").alias("_y")).where("_x != _y")
    return lists.join(sizes.select("shingle", F.ceil(F.col("_n") / PART).cast("int").alias("parts")).hint("merge"), "shingle")


def _crossed(crowd: DataFrame) -> DataFrame:
    """(a, b): pairs of long lists. These have texts without number, so they are dealt into parts; texts without a partner are left out first."""
    part, every = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    many = _in_parts(crowd)
    best = many.groupBy("shingle", "parts", "n", "root").agg(F.max("reach").alias("reach"))
    best = best.withColumn("_k", F.row_number().over(Window.partitionBy("shingle", "n").orderBy(F.desc("reach"), "root"))).where("_k <= 2").withColumn("part", every)
    fit = many.withColumn("part", part).alias("x").hint("merge").join(best.alias("y"), F.expr(f"x.shingle = y.shingle and x.part = y.part and {_fitting('x', 'y')}"), "left_semi")
    many = _in_parts(staged(fit.select("shingle", "id", "root", "n", "reach"), "fitting"))
    one, other = many.withColumn("part", part).alias("x"), many.withColumn("part", every).alias("y")
    met = one.hint("merge").join(other, F.expr(f"x.shingle = y.shingle and x.part = y.part and x.id < y.id and {_fitting('x', 'y')}"))
    return met.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))


def unjoined(named: DataFrame, classes: DataFrame, roots: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b), a < b, of `classes` (one column `id`) that may resemble each other and have different roots, each once.

    Every link is among them, or its ends are joined by the roots and the pairs that are links.
    """
    common, rank = _repeated(named)

    def of(texts: list) -> list[tuple]:
        sets = map(shingle_set, texts)
        return [(len(s), *prefix(s, similarity, common, rank), parity(s)) for s in sets]

    found = per_text(named, "id", "text", "n int, rare array<bigint>, common array<bigint>, bits array<bigint>", lambda: of)
    own = found.join(classes.hint("merge"), "id", "left_semi").join(roots.select(F.col("node").alias("id"), "root").hint("merge"), "id", "left")
    own = own.withColumn("root", F.coalesce("root", "id")).groupBy("id").agg(F.min(F.struct("root", "n", "rare", "common", "bits")).alias("s"))
    own = staged(own.select("id", "s.*"), "prefixes")
    listed = _listed(own, similarity)
    led = staged(_close(_led(listed.where("not few"), similarity), own, similarity), "led_pairs")
    links = staged(_alike(named, led.select("a", "b"), similarity), "led_links")
    moved = components(led.join(links.hint("merge"), ["a", "b"]).select(F.col("x").alias("a"), F.col("y").alias("b")))
    # by root, of which one can have most rows: Spark broadcasts the few that moved, or splits the large ones
    listed = listed.join(moved.select(F.col("node").alias("root"), F.col("root").alias("_to")), "root", "left").withColumn("root", F.coalesce("_to", "root")).drop("_to")
    under = listed.where("few").groupBy("shingle").agg(F.collect_list(F.struct("root", "id", "n", "reach")).alias("ts")).where("array_min(ts).root != array_max(ts).root")
    near = under.select(F.explode(F.expr(f"flatten(transform(ts, a -> transform(filter(ts, b -> a.id < b.id and {_fitting('a', 'b')}), b -> struct(a.id as a, b.id as b))))")).alias("p")).select("p.a", "p.b")
    pairs = near.unionByName(_crossed(listed.where("not few"))).distinct()
    return staged(links.unionByName(_close(pairs, own, similarity)), "unjoined")


def _likely(named: DataFrame, asked: DataFrame) -> DataFrame:
    """The rows of `named` whose id may be among `asked`: none of those is lost, and most others needn't be moved."""
    at = lambda: F.pmod(F.xxhash64("id"), F.lit(64 * WORDS))
    set_bits = asked.select(at().alias("h")).groupBy(F.expr("h div 64").alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(h % 64 as int)))").alias("bits")).toPandas()
    words = np.zeros(WORDS, dtype=np.int64)
    words[set_bits["w"].to_numpy(np.int64)] = set_bits["bits"].to_numpy(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(2).to_numpy()
            yield batch.select(["id", "text"]).filter(pa.array((words[h >> 6] >> (h & 63) & 1).astype(bool)))

    return named.select("id", "text", at().alias("h")).mapInArrow(run, named.select("id", "text").schema)


def _alike(named: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose whole shingle sets resemble each other. Texts are moved, which take less room than their sets."""
    asked = pairs.select(F.col("a").alias("id")).unionAll(pairs.select("b")).distinct()
    texts = _likely(named, asked).join(asked.hint("merge"), "id", "left_semi")
    of_a, of_b = (texts.select(F.col("id").alias(c), F.col("text").alias(f"of_{c}")).hint("merge") for c in "ab")
    both = pairs.join(of_b, "b").join(of_a, "a").select("a", "b", "of_a", "of_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list = [("", shingle_set(""))] * 2
        for part in sliced(batches):
            like = []
            for texts in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                last = [held if held[0] == text else (text, shingle_set(text)) for held, text in zip(last, texts, strict=True)]
                small, large = sorted((held[1] for held in last), key=len)
                common = len(np.intersect1d(small, large, assume_unique=True)) if len(small) and len(small) / len(large) >= similarity else 0
                like.append(common > 0 and common / (len(small) + len(large) - common) >= similarity)
            yield part.select(["a", "b"]).filter(pa.array(like, type=pa.bool_()))

    return both.mapInArrow(run, pairs.select("a", "b").schema)


def resembling(df: DataFrame, ids: DataFrame, similarity: float, id_col: str = "doc_id", text_col: str = "text", joined: DataFrame | None = None) -> DataFrame:
    """(node, root) for each of `ids` (one column `id`) that links of at least `similarity`, and those of `joined` (a, b), join to a smaller id, its root.

    Texts without words have no shingles and are linked to none. Null ids link nothing; of several texts with one id,
    one is compared. An empty table gives no rows. Columns of df other than the two named have no effect.
    """
    import xxhash

    named = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("id is not null")

    def of(texts: list) -> list[tuple]:
        sets = map(shingle_set, texts)
        return [(xxhash.xxh3_128_digest(s.tobytes()), *sketch(s)) for s in sets]

    found = per_text(named, "id", "text", "mark binary, keys array<bigint>, low array<tinyint>", lambda: of)
    chosen = found.where("size(keys) > 0").join(ids.hint("merge"), "id", "left_semi")
    every = staged(chosen.groupBy("id").agg(F.min(F.struct("mark", "keys", "low")).alias("s")).select("id", "s.*"), "sketched")
    sketches = staged(every.groupBy("mark").agg(F.min(F.struct("id", "keys", "low")).alias("s")).select("mark", "s.*"), "sketches")
    copies = every.join(sketches.select("mark", F.col("id").alias("b")).hint("merge"), "mark").where("id != b").select(F.col("id").alias("a"), "b")
    links = copies.unionByName(_alike(named, candidates(sketches, similarity), similarity))
    roots = components(links.unionByName(joined) if joined is not None else links)
    rest = _alike(named, unjoined(named, sketches.select("id"), roots, similarity), similarity)
    return components(rest.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))
