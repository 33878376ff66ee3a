"""Mixing sources to target weights by iterative proportional fitting, in DataFrame functions only.

Token counts are summed into cells of source, language and topic. A document is drawn with the probability of its cell,
min(1, product of one factor for its source, its language and its topic), and the factors are raked until the expected
tokens of the draw meet the targets: `rate` of all tokens, parted by the target shares of sources, languages and topics.
The cap of 1 is part of the fit: cells that reach it leave the raking and what they lack is raked from the others.

There can be any number of sources, so they stay rows of a table, and each row holds its cells of (language, topic);
languages and topics come from closed lists, so their factors are a few numbers. A round solves each source's factor in
its row and then is one aggregation that returns two numbers for each cell of (language, topic): the tokens of capped and
of other cells. A category can't have more than all its tokens: a target above that ceiling is set to it and the rest goes
to the others in proportion. `margins` tells of each category the target asked for, the ceiling and the share reached;
`met` is false where a target was above its ceiling, or where the fit stopped short of it since the three targets can't
be met together.

Null and unlisted languages count as `other`, as do unlisted topics of a topic column (with no `other` target, they aim at
their share of the input); a null source is a source of its own. A share for which there are no tokens is left out and the
rest is scaled up. Documents without tokens have the probability of their cell; cells without any tokens have 0. The draw
hashes the id: rows with one id, null ids among them, have one chance for all.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import staged

OTHER = "other"
#: Topics told apart by form, in the order they are tried; the last takes the rest.
TOPICS = ("legal", "table", "noise", "short", "prose")
#: Target shares of languages and topics.
LANGUAGE_SHARES = {"en": 0.45, "de": 0.2, "fr": 0.2, "es": 0.14, OTHER: 0.01}
TOPIC_SHARES = {"legal": 0.035, "table": 0.035, "noise": 0.05, "short": 0.02, "prose": 0.86}
#: Sources are aimed at shares in proportion to tokens to this power.
SOURCE_POWER = 0.7
#: Largest relative miss of a target, and rounds after which a fit that still misses more is reported as not met.
TOLERANCE, ROUNDS = 1e-3, 100
#: The fit also ends once so many rounds haven't brought the miss down by a hundredth.
STALLED = 6
#: A table of so many sources at most is sent to all executors (two numbers and a name each); a larger one is joined with
#: so many copies of each source, so that no source's rows go to one task.
BROADCAST_SOURCES, COPIES = 100_000, 16
SHORT_TOKENS = 100


def tokens_of(text: Column) -> Column:
    """White-space separated tokens; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def topic_of(text: Column) -> Column:
    """The topic by form; whether a text is short is seen from its first words, without counting the others."""
    return (
        F.when(F.lower(text).rlike(r"licen[sc]e|copyright"), F.lit("legal"))
        .when(text.contains(" | "), F.lit("table"))
        .when(text.rlike(r"[!#%$&*]{2,}"), F.lit("noise"))
        .when(F.coalesce(text.rlike(rf"^\s*+(?:\S++\s++){{{SHORT_TOKENS - 1}}}\S"), F.lit(False)), F.lit("prose"))
        .otherwise(F.lit("short"))
    )


@dataclass(frozen=True)
class Margin:
    """Of a category of a kind (language or topic): shares of the drawn tokens asked for, possible at most, and reached."""

    kind: str
    category: str
    target: float
    ceiling: float
    reached: float
    met: bool


@dataclass
class Mix:
    """sources: a table of source, its factor and its margin; languages, topics: factors; miss: the largest relative one."""

    sources: DataFrame
    languages: dict[str, float]
    topics: dict[str, float]
    miss: float
    rounds: int
    margins: list[Margin] = field(default_factory=list)

    @property
    def infeasible(self) -> list[Margin]:
        return [m for m in self.margins if not m.met]


def prepared(df: DataFrame, id_col: str, text_col: str, source_col: str, lang_col: str, languages: tuple[str, ...], topics: tuple[str, ...] = TOPICS, topic_col: str | None = None) -> DataFrame:
    """id, source, lang, topic, n_tokens of each row."""
    lang, topic = placed(F.col(text_col), F.col(lang_col), languages, topics, F.col(topic_col) if topic_col else None)
    return df.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), lang.alias("lang"), topic.alias("topic"), tokens_of(F.col(text_col)).alias("n_tokens"))


def placed(text: Column, lang: Column, languages: tuple[str, ...], topics: tuple[str, ...], topic: Column | None) -> tuple[Column, Column]:
    """The language and the topic that a row counts as."""
    listed = lambda c, names: F.when(c.isin(*names), c).otherwise(F.lit(OTHER))
    return listed(lang, languages), topic_of(text) if topic is None else listed(topic, topics)


def capped_shares(wanted: dict[str, float], most: dict[str, float]) -> dict[str, float]:
    """Shares that sum to 1, none over its ceiling, in the wanted proportions as far as the ceilings let them."""
    out, free = dict.fromkeys(wanted, 0.0), {c for c, s in wanted.items() if s > 0 and most[c] > 0}
    left = 1.0
    while free:
        scale = left / sum(wanted[c] for c in free)
        over = {c for c in free if wanted[c] * scale >= most[c]}
        if not over:
            return out | {c: wanted[c] * scale for c in free}
        out |= {c: most[c] for c in over}
        left = max(0.0, 1.0 - sum(out.values()))
        free -= over
    # every category with a target is whole, and there is room left: nothing more can be drawn
    return out


def rake(rows: DataFrame, rate: float, language_shares: dict[str, float], topic_shares: dict[str, float], source_power: float = SOURCE_POWER, tolerance: float = TOLERANCE, rounds: int = ROUNDS) -> Mix:
    """The factors for rows of (source, lang, topic, n_tokens), drawn so that `rate` of the tokens is expected."""
    if not 0 < rate <= 1:
        raise ValueError(f"the rate {rate} is not over 0 and up to 1")
    langs, topics = list(language_shares), list(topic_shares)
    langs += [OTHER] * (OTHER not in langs)
    topics += [OTHER] * (OTHER not in topics)
    keys = [(a, b) for a in langs for b in topics]
    cell = lambda a, b: F.coalesce(F.sum(F.when((F.col("lang") == a) & (F.col("topic") == b), F.col("n_tokens"))).cast("double"), F.lit(0.0))
    whole = F.aggregate("n", F.lit(0.0), lambda x, y: x + y)
    cells = staged(rows.groupBy("source").agg(F.array(*(cell(a, b) for a, b in keys)).alias("n")).withColumn("tokens", whole).withColumn("aim", F.pow("tokens", F.lit(source_power))), "cells")
    first = cells.agg(*(F.sum(F.col("n")[i]).alias(f"k{i}") for i in range(len(keys))), F.sum("aim").alias("aims")).first()
    had = dict(zip(keys, (first[f"k{i}"] or 0.0 for i in range(len(keys))), strict=True))
    total = sum(had.values())
    if not total:
        return Mix(cells.select("source", F.lit(0.0).alias("factor"), *(F.lit(0.0).alias(c) for c in ("target", "ceiling", "reached"))), dict.fromkeys(langs, 1.0), dict.fromkeys(topics, 1.0), 0.0, 0)
    drawn = rate * total

    def margin(held: dict, own: int, names: list[str]) -> dict[str, float]:
        return {c: sum(v for k, v in held.items() if k[own] == c) for c in names}

    def aims(wanted: dict[str, float], own: int, names: list[str]) -> tuple[dict, dict, dict]:
        """Shares asked for (of those that have tokens), ceilings, and shares that are aimed at."""
        there = margin(had, own, names)
        rest = sum(n for c, n in there.items() if c not in wanted) / total
        alive = sum(s for c, s in wanted.items() if there[c])
        asked = {c: (wanted[c] / alive * (1 - rest) if alive and there[c] else 0.0) if c in wanted else there[c] / total / (1 if alive else rest) for c in names}
        most = {c: there[c] / drawn for c in names}
        return asked, most, capped_shares(asked, most)

    asked_lang, most_lang, want_lang = aims(language_shares, 0, langs)
    asked_topic, most_topic, want_topic = aims(topic_shares, 1, topics)

    # what each source shall give: in proportion to its aim, or all it has
    level, capped = drawn / first.aims, -1.0
    while True:
        row = cells.agg(F.sum(F.when(F.col("aim") * level >= F.col("tokens"), F.col("tokens")).otherwise(0.0)).alias("k"), F.sum(F.when(F.col("aim") * level < F.col("tokens"), F.col("aim")).otherwise(0.0)).alias("free")).first()
        if row.k <= capped or not row.free:
            break
        level, capped = (drawn - row.k) / row.free, row.k

    # what a round changes goes in as array literals, so that the same compiled code serves all rounds
    numbers = lambda values: F.array(*(F.lit(float(v)) for v in values))
    f_lang, f_topic = ({c: 1.0 if s else 0.0 for c, s in want.items()} for want in (want_lang, want_topic))

    weights = lambda: numbers(f_lang[a] * f_topic[b] for a, b in keys)

    def solved() -> DataFrame:
        """The sources with the factor that brings each to its aim, given the others.

        The expected tokens, sum of n * min(1, f * y), are the least over thresholds t of what is whole above t plus f
        times n * y of the rest; so the factor is the largest that any threshold asks for.
        """
        pairs = F.filter(F.zip_with("n", weights(), lambda n, v: F.struct(n.alias("n"), v.alias("y"))), lambda p: (p["n"] > 0) & (p["y"] > 0))
        goal = F.least(F.col("tokens"), F.col("aim") * level)
        above = lambda t: F.aggregate("_p", F.lit(0.0), lambda x, p: x + F.when(p["y"] > t, p["n"]).otherwise(0.0))
        below = lambda t: F.aggregate("_p", F.lit(0.0), lambda x, p: x + F.when(p["y"] <= t, p["n"] * p["y"]).otherwise(0.0))
        factor = F.array_max(F.transform("_p", lambda q: (F.col("_goal") - above(q["y"])) / below(q["y"])))
        return cells.withColumn("_p", pairs).withColumn("_goal", goal).withColumn("factor", F.greatest(F.coalesce(factor, F.lit(0.0)), F.lit(0.0)))

    misses: list[float] = []
    done, miss, by_lang, by_topic = 0, float("inf"), {}, {}
    full = F.col("factor") * F.col("c.y") >= 1

    def raked(factors: dict[str, float], want: dict[str, float], own: int, names: list[str], whole_cells: dict, open_cells: dict) -> dict[str, float]:
        """The step of each factor that brings its category to its target, the capped cells left as they are."""
        c, u = margin(whole_cells, own, names), margin(open_cells, own, names)
        steps = {}
        for name in names:
            goal = want[name] * drawn
            if not goal:
                steps[name] = 0.0
            elif c[name] < goal and u[name] > 0:
                steps[name] = (goal - c[name]) / u[name]
            else:
                steps[name] = goal / (c[name] + u[name]) if c[name] + u[name] else 1.0
        factors |= {n: f * steps[n] for n, f in factors.items()}
        return steps

    for done in range(1, rounds + 1):
        # the cells become rows below which the factor is already computed, once for each source
        each = solved().select("factor", F.posexplode(F.zip_with("n", weights(), lambda n, y: F.struct(n.alias("n"), y.alias("y")))).alias("at", "c"))
        each = each.groupBy("at").agg(F.sum(F.when(full, F.col("c.n")).otherwise(0.0)).alias("whole"), F.sum(F.when(full, 0.0).otherwise(F.col("c.n") * F.col("c.y") * F.col("factor"))).alias("open"))
        found = {r["at"]: r for r in each.collect()}
        whole_cells, open_cells = ({k: found[i][x] for i, k in enumerate(keys)} for x in ("whole", "open"))
        held = {k: whole_cells[k] + open_cells[k] for k in keys}
        by_lang, by_topic = margin(held, 0, langs), margin(held, 1, topics)
        miss = max([abs(by_lang[c] / drawn / s - 1) for c, s in want_lang.items() if s] + [abs(by_topic[c] / drawn / s - 1) for c, s in want_topic.items() if s], default=0.0)
        misses.append(miss)
        if miss <= tolerance or done == rounds or (done > STALLED and miss > 0.99 * misses[-1 - STALLED]):
            break
        steps = raked(f_lang, want_lang, 0, langs, whole_cells, open_cells)
        moved = {k: v * steps[k[0]] for k, v in open_cells.items()}
        raked(f_topic, want_topic, 1, topics, whole_cells, moved)
        # only products count: keep the numbers near 1
        scale = max(f_lang.values())
        f_lang = {c: f / scale for c, f in f_lang.items()}

    reached = lambda by, asked, most, kind: [Margin(kind, c, asked[c], most[c], by[c] / drawn, abs(by[c] / drawn - asked[c]) <= tolerance * asked[c]) for c in by if asked[c]]
    given = F.aggregate(F.zip_with("n", weights(), lambda n, y: n * F.least(F.lit(1.0), y * F.col("factor"))), F.lit(0.0), lambda x, v: x + v)
    fitted = staged(solved().select("source", "n", "factor", (F.col("aim") / first.aims).alias("target"), (F.col("tokens") / drawn).alias("ceiling")), "raked")
    sources = fitted.select("source", "factor", "target", "ceiling", (given / drawn).alias("reached"))
    return Mix(sources, f_lang, f_topic, miss, done, reached(by_lang, asked_lang, most_lang, "language") + reached(by_topic, asked_topic, most_topic, "topic"))


def element(names: dict, key: str) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for kv in names.items() for x in kv)), F.col(key)) if names else F.lit(None).cast("double")


def probability(mix: Mix) -> Column:
    """The probability of a row with lang, topic and its source's factor."""
    return F.least(F.lit(1.0), F.coalesce(F.col("factor"), F.lit(0.0)) * element(mix.languages, "lang") * element(mix.topics, "topic"))


def chance(id_col: Column, seed: int) -> Column:
    """A number in [0, 1) from the id and the seed; the same for equal ids."""
    return F.pmod(F.xxhash64(id_col, F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))


def with_factors(rows: DataFrame, mix: Mix, salt: Column) -> DataFrame:
    """Rows with their source's factor: by broadcast where the sources are counted as few, else with salted keys."""
    factors = mix.sources.withColumnRenamed("source", "of")
    same = F.col("source").eqNullSafe(F.col("of"))
    if factors.count() <= BROADCAST_SOURCES:
        return rows.join(F.broadcast(factors), same, "left").drop("of")
    copies = factors.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    return rows.withColumn("_salt", F.pmod(F.xxhash64(salt), F.lit(COPIES)).cast("int")).join(copies, same & (F.col("_salt") == F.col("_copy")), "left").drop("of", "_salt", "_copy")


def sample(df: DataFrame, rate: float = 0.5, seed: int = 17, language_shares: dict[str, float] | None = None, topic_shares: dict[str, float] | None = None, source_power: float = SOURCE_POWER, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", topic_col: str | None = None) -> DataFrame:
    """id, source, lang, topic, n_tokens, probability and selected of every row of df, and for its source, language and
    topic the shares of the drawn tokens that were asked for and that the draw is expected to reach."""
    language_shares, topic_shares = language_shares or LANGUAGE_SHARES, topic_shares or TOPIC_SHARES
    rows = staged(prepared(df, id_col, text_col, source_col, lang_col, tuple(language_shares), tuple(topic_shares), topic_col), "tokens")
    mix = rake(rows, rate, language_shares, topic_shares, source_power)
    drawn = with_factors(rows, mix, F.struct("id", "n_tokens")).withColumn("probability", probability(mix))
    of = lambda kind, what: {m.category: getattr(m, what) for m in mix.margins if m.kind == kind}
    shares = [F.coalesce(element(of(kind, what), key), F.lit(0.0)).alias(f"{key}_{what}") for kind, key in (("language", "lang"), ("topic", "topic")) for what in ("target", "reached")]
    return drawn.select(F.col("id").alias(id_col), "source", "lang", "topic", "n_tokens", "probability", (chance(F.col("id"), seed) < F.col("probability")).alias("selected"), F.col("target").alias("source_target"), F.col("reached").alias("source_reached"), *shares)


def keep_sample(df: DataFrame, rate: float, seed: int = 17, language_shares: dict[str, float] | None = None, topic_shares: dict[str, float] | None = None, source_power: float = SOURCE_POWER, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", topic_col: str | None = None) -> DataFrame:
    """The drawn rows of df in its own columns; the text is not shuffled where the sources are few.

    The topic is told twice, for the cells and for the draw: reading the text again is cheaper than shuffling it by id.
    """
    language_shares, topic_shares = language_shares or LANGUAGE_SHARES, topic_shares or TOPIC_SHARES
    rows = prepared(df, id_col, text_col, source_col, lang_col, tuple(language_shares), tuple(topic_shares), topic_col)
    mix = rake(rows, rate, language_shares, topic_shares, source_power)
    names = df.columns
    own = lambda name: F.col("row").getField(name)
    lang, topic = placed(own(text_col), own(lang_col), tuple(language_shares), tuple(topic_shares), own(topic_col) if topic_col else None)
    whole = df.select(F.struct(*(F.col(f"`{n}`") for n in names)).alias("row"))
    parted = whole.select("row", own(source_col).cast("string").alias("source"), lang.alias("lang"), topic.alias("topic"))
    drawn = with_factors(parted, mix, own(id_col)).where(chance(own(id_col), seed) < probability(mix))
    return drawn.select(*(own(n).alias(n) for n in names))
