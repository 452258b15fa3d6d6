"""Quality rules whose cutoffs are certified on labelled documents.

A rule rejects a document whose measure lies beyond a cutoff. For every stratum and rule,
the good documents of the labelled holdout are counted beyond each of a fixed series of
nested cutoffs, from the loosest to the strictest. A cutoff is certified when the exact
binomial probability of seeing so few rejections, were the true share of falsely rejected
documents the allowed one, is at most the corrected level: cutoffs are tested in their
order, which needs no correction since they are nested, and the level is divided by
strata times rules (Bonferroni). The strictest certified cutoff is used; where none is,
the rule is off. The allowed share is divided among the rules, so that with probability
``1 - level`` no stratum loses more than ``allowed`` of its good documents.

That spends the budget on five rules at once and needs about 3,000 good documents of a
stratum. :func:`joint_depths` spends it on one nested path of rule sets instead, for which some
459 are enough with four strata, and has a depth certified over all strata for those with fewer.

Everything is a Spark expression. A text is measured inside its row: no window of words
leaves it, and the only shuffles are of per-stratum counts and of narrow measures.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverline.llm.shared import cut, free_names, without

WINDOW = 5  # words in a window
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
ALLOWED, LEVEL = 0.01, 0.05


@dataclass(frozen=True)
class Rule:
    """Rejects what exceeds a cutoff; ``cutoffs`` rise, so the last is the loosest."""

    name: str
    measure: str  # SQL over the measures
    cutoffs: tuple[float, ...]


RULES = (
    Rule("symbols per word", "n_symbols / n_words", (0.1, 0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0)),
    Rule("repeated lines per word", "n_dup_lines / n_words", (0.01, 0.02, 0.03, 0.05, 0.08, 0.12, 0.2)),
    Rule("words in repeated windows", "n_repeat_words / n_words", (0.02, 0.05, 0.08, 0.1, 0.12, 0.15, 0.18)),
    Rule("long words", "word_chars / n_words", (7.0, 8.0, 9.0, 10.0, 12.0, 15.0, 20.0)),
    Rule("short words", "-word_chars / n_words", (-4.0, -3.5, -3.0, -2.5, -2.0, -1.5)),
)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the five measures (long) and ``base_failed``.

    Words are maximal runs other than the six ASCII white-space characters; NULL has none.
    ``n_symbols`` counts ``#*$%&|<>``, ``n_dup_lines`` the lines with a word that equal an
    earlier line, ``n_repeat_words`` the words covered by five-word windows that occur twice
    or more in the text. Columns of these names are replaced. Rows are independent: repeated
    rows and ids do not matter, an empty table gives no rows, and a long text costs memory
    in proportion to its length.
    """
    docs = without(docs, *MEASURES, "base_failed")
    words, lines = free_names(docs, "_words", "_lines")
    body = F.coalesce(F.col(text), F.lit(""))
    split = docs.select(
        "*",
        F.array_remove(F.split(body, r"[\x20\x09-\x0D]+"), "").alias(words),
        F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias(lines),
        F.length(F.regexp_replace(body, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
    )
    measures = F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.col("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.expr(_repeat_words(words)).alias("n_repeat_words"),
    )
    # A generator of one row, so that a filter above never computes the measures a second time.
    counted = split.select(*docs.columns, F.inline(F.array(measures)))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return counted.select(*docs.columns, *MEASURES, failed.alias("base_failed"))


def _let(name: str, value: str, body: str) -> str:
    """SQL for ``body`` with ``value`` computed once and called ``name``."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _repeat_words(words: str) -> str:
    """SQL for the number of words in windows that occur twice or more.

    Equal windows have equal hashes, so only texts with a repeated hash are looked at again, by the words.
    """
    hashes = f"transform(sequence(1, size(h) - {WINDOW - 1}), i -> xxhash64(slice(h, i, {WINDOW})))"
    suspect = _let("h", "transform(w, x -> xxhash64(x))", _let("g", hashes, "size(array_distinct(g)) < size(g)"))
    windows = f"transform(sequence(0, size(w) - {WINDOW}), i -> struct(array_join(slice(w, i + 1, {WINDOW}), ' ') as text, i as at))"
    # In the order of their text, a window is repeated if it equals the one before or after it.
    as_next = "zip_with(s, slice(s, 2, size(s)), (a, b) -> coalesce(a.text = b.text, false))"
    twice = "zip_with(e, concat(array(false), e), (a, b) -> coalesce(a, false) or b)"
    places = f"array_compact(zip_with(s, {twice}, (x, t) -> if(t, x.at, null)))"
    covered = f"aggregate(zip_with(p, slice(p, 2, size(p)), (a, b) -> least({WINDOW}, coalesce(b - a, {WINDOW}))), 0, (n, x) -> n + x)"
    exact = _let("s", f"sort_array({windows})", _let("e", as_next, _let("p", f"sort_array({places})", covered)))
    return _let("w", f"`{words}`", f"cast(if(size(w) < {WINDOW}, 0, if({suspect}, {exact}, 0)) as bigint)")


def _level(rule: Rule) -> Column:
    """How many cutoffs of the rule the document exceeds; 0 for a document without words."""
    beyond = " + ".join(f"if({rule.measure} > {c}D, 1, 0)" for c in rule.cutoffs)
    return F.expr(f"if(n_words > 0, {beyond}, 0)")


def _stratum(column: str) -> Column:
    """The stratum as text that is never NULL; NULL is apart from every value."""
    return F.when(F.col(column).isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), F.col(column).cast("string")))


def binomial_tail(k: str, n: str, share: float) -> str:
    """SQL for P(X <= k), X binomial(n, share), summed in logarithms; 1 where k is above the mean."""
    odds = share / (1 - share)
    return f"""if({k} > {n} * {share!r}D, 1D, least(1D, aggregate(
        if({k} < 1, cast(array() as array<bigint>), sequence(1L, {k})),
        named_struct('term', {n} * ln({1 - share!r}D), 'sum', {n} * ln({1 - share!r}D)),
        (acc, i) -> named_struct(
            'term', acc.term + ln(({n} - i + 1) / i * {odds!r}D),
            'sum', greatest(acc.sum, acc.term + ln(({n} - i + 1) / i * {odds!r}D))
                + ln(1 + exp(-abs(acc.sum - acc.term - ln(({n} - i + 1) / i * {odds!r}D))))),
        acc -> exp(acc.sum))))"""


def certified_cutoffs(
    docs: DataFrame,
    labels: DataFrame,
    stratum: str = "lang",
    key: str = "doc_id",
    allowed: float = ALLOWED,
    level: float = LEVEL,
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """One row per stratum with a certified cutoff: ``stratum``, ``good`` (holdout documents) and an
    array ``needed``. Certifying takes ``log(rules * strata / level) / share`` good documents at least
    (about 3,000 with the defaults), so rows are that many times fewer than labels.

    ``docs`` carries the measures. ``needed[r]`` is the number of cutoffs that a document has
    to exceed to be rejected by rule ``r``; more than there are if no cutoff is certified.
    The holdout is every document with a label whose least ``quality`` is 1 and that the base
    rules keep. Without labels there are no rows, and no rule is on.
    """
    good = labels.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("quality").alias("q")).where("q = 1")
    held = (
        docs.where(~F.col("base_failed"))
        .select(F.col(key), _stratum(stratum).alias("stratum"), *[_level(r).alias(f"level{i}") for i, r in enumerate(rules)])
        .join(good.select(key), key, "left_semi")
    )
    counts = held.groupBy("stratum").agg(
        F.count(F.lit(1)).alias("good"),
        *[
            F.array(*[F.sum((F.col(f"level{i}") >= t).cast("long")) for t in range(1, len(r.cutoffs) + 1)]).alias(f"beyond{i}")
            for i, r in enumerate(rules)
        ],
    )
    counts = counts.withColumn("strata", F.count(F.lit(1)).over(Window.partitionBy()))
    share = allowed / len(rules)
    needed = [
        F.expr(
            f"{len(r.cutoffs)} + 1 - size(filter(beyond{i}, k -> {binomial_tail('k', 'good', share)} <= {level!r}D / ({len(rules)} * strata)))"
        )
        for i, r in enumerate(rules)
    ]
    found = counts.select("stratum", "good", F.array(*needed).alias("needed"))
    return found.where(" or ".join(f"needed[{i}] <= {len(r.cutoffs)}" for i, r in enumerate(rules)))


def quality_verdicts(
    docs: DataFrame, cutoffs: DataFrame, stratum: str = "lang", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """Measured ``docs`` with ``kept``; ``cutoffs`` from :func:`certified_cutoffs`.

    A stratum without a row of cutoffs is judged by the base rules alone. The cutoffs are broadcast
    (see there for their bound): documents of one stratum, however many, never meet in a task.
    """
    docs = without(docs, "kept")
    mine, needed = free_names(docs, "_stratum", "_needed")
    table = cutoffs.select(F.col("stratum").alias(mine), F.col("needed").alias(needed))
    judged = docs.withColumn(mine, _stratum(stratum)).join(F.broadcast(table), mine, "left")
    rejected = F.lit(False)
    for i, rule in enumerate(rules):
        rejected = rejected | F.coalesce(_level(rule) >= F.col(needed)[i], F.lit(False))
    return judged.select(*docs.columns, (~F.col("base_failed") & ~rejected).alias("kept"))


# Rules whose measures mean the same in every language; the path takes them first.
ALIKE = 3


def path_step(rules: tuple[Rule, ...] = RULES) -> Column:
    """The step of the path at which a measured document is first rejected, from 0; NULL if none.

    The path is one series of nested rule sets: each step adds a cutoff, rule by rule in their order
    and from the loosest cutoff to the strictest, to all that came before.
    """
    steps, start = [], 0
    for rule in rules:
        level, start = _level(rule), start + len(rule.cutoffs)
        steps.append(F.when(level > 0, start - level))
    return F.least(*steps)


def joint_depths(
    docs: DataFrame,
    labels: DataFrame,
    stratum: str = "lang",
    key: str = "doc_id",
    allowed: float = ALLOWED,
    level: float = LEVEL,
    rules: tuple[Rule, ...] = RULES,
    alike: int = ALIKE,
) -> DataFrame:
    """How many steps of the path are certified: ``stratum``, ``good`` (holdout documents), ``depth``.

    One row has a NULL stratum: it is over all strata together and counts for each that has no row.
    The holdout is that of :func:`certified_cutoffs`. A step is certified when so few good documents
    rejected by the whole set up to it would have at most ``level / (strata + 1)`` probability if the
    true share were ``allowed``. Steps are nested and tested in order, which needs no correction. So
    with probability ``1 - level`` no stratum with a depth of its own loses more than ``allowed`` of
    its good documents, and neither do all labelled strata together by the common depth. That is no
    promise for each stratum that the common depth serves: it has only the first ``alike`` rules,
    and no step that rejects more than ``allowed`` of a stratum's own few good documents.

    A stratum with enough good documents has its own depth, were it 0. Others have a row only where
    their own documents speak against the common depth, so rows are far fewer than labels.
    """
    total = sum(len(r.cutoffs) for r in rules)
    good = labels.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("quality").alias("q")).where("q = 1")
    held = (
        docs.where(~F.col("base_failed"))
        .select(F.col(key), _stratum(stratum).alias("stratum"), path_step(rules).alias("step"))
        .join(good.select(key), key, "left_semi")
    )
    beyond = lambda d: F.sum(F.coalesce((F.col("step") < d).cast("long"), F.lit(0)))
    counts = held.groupBy("stratum").agg(
        F.count(F.lit(1)).alias("good"), F.array(*[beyond(d) for d in range(1, total + 1)]).alias("beyond")
    )
    counts = cut(counts)
    certified = lambda of, most: f"size(filter(slice({of}, 1, {most}), k -> {binomial_tail('k', 'good', allowed)} <= {level!r}D / (strata + 1)))"
    common = counts.agg(
        F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.array(*[F.coalesce(F.sum(F.col("beyond")[d]), F.lit(0)) for d in range(total)]).alias("beyond"),
        F.count(F.lit(1)).alias("strata"),
    )
    most = sum(len(r.cutoffs) for r in rules[:alike])
    common = common.select("good", "strata", F.expr(certified("beyond", most)).alias("depth"))
    own = counts.crossJoin(F.broadcast(common.select("strata", F.col("depth").alias("common"))))
    enough = F.expr(f"{binomial_tail('0L', 'good', allowed)} <= {level!r}D / (strata + 1)")
    tolerated = F.least("common", F.expr(f"size(filter(beyond, k -> k <= {allowed!r}D * good))"))
    own = own.withColumn("enough", enough).withColumn(
        "depth", F.when(F.col("enough"), F.expr(certified("beyond", total))).otherwise(tolerated)
    )
    everywhere = common.select(F.lit(None).cast("string").alias("stratum"), "good", "depth")
    return own.where("enough or depth < common").select("stratum", "good", "depth").union(everywhere)


def joint_verdicts(
    docs: DataFrame, depths: DataFrame, stratum: str = "lang", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """Measured ``docs`` with ``kept``; ``depths`` from :func:`joint_depths`, which are broadcast."""
    docs = without(docs, "kept")
    mine, depth, common = free_names(docs, "_stratum", "_depth", "_common")
    table = depths.where("stratum IS NOT NULL").select(F.col("stratum").alias(mine), F.col("depth").alias(depth))
    everywhere = depths.where("stratum IS NULL").select(F.col("depth").alias(common))
    judged = docs.withColumn(mine, _stratum(stratum)).join(F.broadcast(table), mine, "left").crossJoin(F.broadcast(everywhere))
    rejected = F.coalesce(path_step(rules) < F.coalesce(depth, common), F.lit(False))
    return judged.select(*docs.columns, (~F.col("base_failed") & ~rejected).alias("kept"))
