"""Near-duplicates by SimHash fingerprints and covering locality-sensitive hashing.

A fingerprint has 64 bits: a bit is 1 if it is set in over half the XXH64 hashes (seed 42) of a text's three-word
shingles. Each bit position is given a non-zero vector of three bits; table v (1 to 7) keeps the positions whose vector
has an odd product with v. Two fingerprints that differ in two positions have two vectors, to which some v is
orthogonal: they agree on all that table v keeps, so each pair within the radius meets in one of seven buckets.

Only distinct fingerprints are hashed. Buckets of few members are compared within the row; members of larger buckets
are written out with their one-bit variants, and two fingerprints are within two bits of each other exactly if they
share a variant, which no more than 65 can. So no bucket is gathered whole and no link is lost.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import per_text, staged
from lectern.llm.components import components
from lectern.llm.resemblance import resembling

SHINGLE, SEED, RADIUS, BITS = 3, 42, 2, 64
#: Buckets up to this size are compared in place.
SMALL_BUCKET = 32


def hashes(text: str | None) -> np.ndarray:
    """XXH64 of each shingle, repeats included; of all words joined if there are fewer words than a shingle has."""
    import xxhash

    words = (text or "").encode().lower().split()
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else [], dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    return np.array([digest(s, SEED) for s in map(b" ".join, zip(*(words[k:] for k in range(SHINGLE)), strict=False))], dtype=np.uint64)


def fingerprint(text: str | None) -> int:
    """The fingerprint as a signed 64-bit integer; 0 for a text without words."""
    h = hashes(text)
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(h), 4096):
        counts += np.unpackbits(h[at : at + 4096].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(h), bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return per_text(df, id_col, text_col, "fp bigint", lambda: lambda texts: [(fingerprint(t),) for t in texts])


def table_masks() -> list[int]:
    """The positions that each of the seven tables keeps, as signed 64-bit masks."""
    vectors = [1 + k % 7 for k in range(BITS)]
    masks = [sum(1 << k for k in range(BITS) if (vectors[k] & v).bit_count() % 2) for v in range(1, 8)]
    return [m - (1 << BITS) if m >> BITS - 1 else m for m in masks]


def links(classes: DataFrame) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints `fp` that connect whatever links of two or fewer differing bits connect."""
    keys = F.array(*(F.struct(F.lit(k).alias("table"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for k, m in enumerate(table_masks())))
    placed = classes.select("fp", F.explode(keys).alias("at")).select("fp", "at.table", "at.key")
    sizes = placed.groupBy("table", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = staged(placed.join(sizes, ["table", "key"]), "met")
    few = met.where(F.col("n") <= SMALL_BUCKET).groupBy("table", "key").agg(F.collect_list("fp").alias("fps"))
    near = F.expr(f"flatten(transform(fps, a -> transform(filter(fps, b -> b > a and bit_count(a ^ b) <= {RADIUS}), b -> struct(a, b))))")
    close = few.select(F.explode(near).alias("p")).select("p.a", "p.b")
    many = met.where(F.col("n") > SMALL_BUCKET).select("fp").distinct()
    variants = F.array(F.col("fp"), *(F.col("fp").bitwiseXOR(F.lit((1 << k) - (1 << BITS if k == BITS - 1 else 0))) for k in range(BITS)))
    shared = many.select("fp", F.explode(variants).alias("variant")).groupBy("variant").agg(F.collect_list("fp").alias("fps")).where("size(fps) > 1")
    hubs = shared.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a != b")
    return close.unionByName(hubs)


def groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, fingerprint (16 hex digits), component_id: the least id that links reach; one row per row of df.

    Null and empty texts have the fingerprint zero and are linked like others. A null id stays null, and a component of
    null ids only has a null component_id; repeated rows are kept. An empty table gives no rows.
    """
    ids = staged(fingerprints(df, id_col, text_col).withColumnRenamed(id_col, "id"), "fingerprints")
    classes = ids.groupBy("fp").agg(F.min("id").alias("first_id"))
    roots = components(links(classes))
    rooted = classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = staged(rooted.join(least, "root").select("fp", "component_id"), "named")
    out = ids.join(named, "fp")
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float | None = None) -> DataFrame:
    """The rows of df whose document has the least id of its group, in df's own columns.

    With a similarity, texts are also linked by the resemblance of their five-word shingles, which fingerprints can't
    tell: all texts, not one of each fingerprint group, as a text can resemble others that the least of its group doesn't.
    The groups are those of both kinds of links together.
    Rows with a null id can't be told apart and all stay; of repeated rows with one id, one stays.
    """
    found = groups(df, id_col, text_col)
    kept = found.where(F.col(id_col) == F.col("component_id"))
    repeated = staged(kept.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).select(F.col(id_col).alias("_kept"), F.col("n").alias("_rows")), "kept")
    if similarity is not None:
        members = found.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("a")).agg(F.min("component_id").alias("b"))
        members = staged(members, "members")
        alike = resembling(df, members.select(F.col("a").alias("id")), similarity, id_col, text_col, members)
        repeated = staged(repeated.join(alike.select(F.col("node").alias("_kept")).hint("merge"), "_kept", "left_anti"), "apart")
    # the kept ids grow with the rows, so they are never broadcast, however few they are in a small table
    once = df.join(repeated.where("_rows = 1").select("_kept").hint("merge"), F.col(id_col) == F.col("_kept"), "left_semi")
    parts = [once]
    if not repeated.where("_rows > 1").isEmpty():
        again = df.join(repeated.where("_rows > 1").select("_kept").hint("merge"), F.col(id_col) == F.col("_kept"), "left_semi")
        parts.append(again.dropDuplicates([id_col]))
    parts.append(df.where(F.col(id_col).isNull()))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


