"""Mixing sources to target weights by iterative proportional fitting, in DataFrame operations only.

Documents are summed to cells (source, language, topic). The cells' token weights are raked
until their source, language and topic marginals meet the targets; a cell's factor is its
raked weight over its tokens. Inclusion probabilities are min(1, k * factor), with k calibrated
so that the expected tokens are the wanted share, and a document is drawn if the hash of its
id is below its cell's probability.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scope, join_to_unique, session_scope

DIMENSIONS = ("source", "lang", "topic")
ALPHA, SHARE = 0.7, 0.8
#: Raking goes on, SWEEPS at a time, until no marginal is further than this share from its target; at most so many sweeps.
SWEEPS, TOLERANCE, MOST_SWEEPS = 8, 1e-6, 800
#: Sweeps that leave more than this share of the residual do not help.
STALLED = 0.999
BYTES_PER_TOKEN = 4
#: Characters from which a text is of medium length, and long.
SHORT, LONG = 1000, 5000
#: Cells that are raked in one task; above it marginals are aggregates joined back.
ONE_TASK = 1_000_000
#: Cells whose probabilities are broadcast (some 100 bytes each); above it they are joined by a shuffle that splits hot cells.
BROADCAST = 20_000


def topic_of(text: Column) -> Column:
    """A form class of the whole text, for tables without a topic: one line or several, and short, medium or long.

    It says nothing of the language, so that targets of both can be met together.
    """
    chars = F.length(F.coalesce(text, F.lit("")))
    form = F.when(F.contains(F.coalesce(text, F.lit("")), F.lit("\n")), "lines").otherwise("line")
    return F.concat(form, F.when(chars < SHORT, "-short").when(chars < LONG, "-medium").otherwise("-long"))


def token_weight(text: Column) -> Column:
    """Estimated tokens: a token for each BYTES_PER_TOKEN bytes begun, and the end token."""
    return (F.floor((F.octet_length(F.coalesce(text, F.lit(""))) + BYTES_PER_TOKEN - 1) / BYTES_PER_TOKEN) + 1).cast("long")


def draw_of(doc_id: Column) -> Column:
    """A number in [0, 1) from the id's md5; a null id is drawn as the empty text."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(1 << 32)


def _along(rows: DataFrame, dimension: str, column: str, name: str, one: bool, scope: Scope) -> DataFrame:
    """Adds the sum of a column over the cells that share the dimension's value."""
    if one:
        return rows.withColumn(name, F.sum(column).over(Window.partitionBy(dimension)))
    rows = scope.write(rows, "cells")
    return rows.join(rows.groupBy(dimension).agg(F.sum(column).alias(name)), dimension)


def aimed(cells: DataFrame, scope: Scope, one: bool, alpha: float = ALPHA, targets: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """Adds weight, the tokens, and to_ each dimension, the target of the cell's marginal.

    A dimension's target shares are ``targets[dimension]`` (by value, all values given) or its
    own token shares to the power alpha; both are brought to the sum of the tokens.
    """
    everything = float(cells.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0])
    out = cells.withColumn("weight", F.col("tokens").cast("double"))
    for d in DIMENSIONS:
        out = _along(out, d, "tokens", f"own_{d}", one, scope)
        if targets and d in targets:
            given = F.create_map(*[F.lit(x) for kv in targets[d].items() for x in kv])
            out = out.withColumn(f"to_{d}", F.coalesce(given[F.col(d)], F.lit(0.0)))
        else:
            out = out.withColumn(f"to_{d}", F.pow(F.col(f"own_{d}").cast("double") / F.lit(everything), F.lit(alpha)))
    out = scope.write(out, "targets")
    total = out.agg(*[F.sum(F.col(f"to_{d}") * F.col("tokens") / F.col(f"own_{d}")) for d in DIMENSIONS]).first()
    scaled = [(F.col(f"to_{d}") / F.lit(t) * F.lit(everything)).alias(f"to_{d}") for d, t in zip(DIMENSIONS, total, strict=True)]
    return out.select(*cells.columns, "weight", *scaled)


def swept(out: DataFrame, scope: Scope, one: bool, sweeps: int | None = None) -> DataFrame:
    """Weights of aimed cells raked along each dimension in turn, SWEEPS times by default."""
    columns = out.columns
    for _ in range(sweeps or SWEEPS):
        for d in DIMENSIONS:
            out = _along(out, d, "weight", "held", one, scope)
            out = out.withColumn("weight", F.when(F.col("held") > 0, F.col("weight") * F.col(f"to_{d}") / F.col("held")).otherwise(F.lit(0.0))).select(*columns)
    return out


def residual(out: DataFrame) -> float:
    """The largest share by which a marginal misses its target."""
    off = 0.0
    for d in DIMENSIONS:
        sums = out.groupBy(d).agg(F.sum("weight").alias("held"), F.max(f"to_{d}").alias("to")).where("to > 0")
        off = max(off, sums.agg(F.max(F.abs(F.col("held") / F.col("to") - 1))).first()[0] or 0.0)
    return off


def rake(cells: DataFrame, scope: Scope, one: bool, alpha: float = ALPHA, sweeps: int | None = None, targets: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """Adds weight: tokens raked to the target marginals, by so many sweeps or until all are within TOLERANCE; with ``one``, a task has all cells.

    Targets that no weights of these cells meet end with a warning that tells the residual, where sweeps no longer lower it.
    """
    whole = lambda rows: rows.coalesce(1) if one else rows
    state = whole(aimed(cells, scope, one, alpha, targets))
    if sweeps is not None:
        return swept(state, scope, one, sweeps).select(*cells.columns, "weight")
    off, done = float("inf"), 0
    while True:
        state, done = whole(scope.write(swept(state, scope, one), "raked")), done + SWEEPS
        before, off = off, residual(state)
        if off <= TOLERANCE:
            break
        if done >= MOST_SWEEPS or off > STALLED * before:
            warnings.warn(f"raking ends after {done} sweeps with a marginal {off:.3g} of its target away", stacklevel=2)
            break
    return state.select(*cells.columns, "weight")


def calibrate(raked: DataFrame, share: float = SHARE) -> DataFrame:
    """Adds factor and probability = min(1, k * factor), with k such that share of all tokens is expected.

    k rises as cells of probability 1 leave the sum, and is final once no more leave. raked is a written table.
    """
    out = raked.withColumn("factor", F.col("weight") / F.col("tokens"))
    everything = out.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    wanted, k, before = float(everything) * share, None, None
    while True:
        sure = F.lit(False) if k is None else F.lit(k) * F.col("factor") >= 1
        n, taken, rest = out.agg(F.count_if(sure), F.coalesce(F.sum(F.when(sure, F.col("tokens"))), F.lit(0)), F.sum(F.when(~sure, F.col("factor") * F.col("tokens")))).first()
        if k is not None and n == before:
            break
        if not rest or wanted <= taken:
            # even all documents of the cells that have weight are fewer tokens than wanted
            k = None if not rest else k
            break
        k, before = (wanted - taken) / rest, n
    probability = F.when(F.col("factor") > 0, 1.0).otherwise(0.0) if k is None else F.least(F.lit(1.0), F.lit(k) * F.col("factor"))
    return out.withColumn("probability", probability)


def mixed(docs: DataFrame, *, scope: Scope | None = None, id_column: str = "doc_id", text_column: str = "text", topic: Column | None = None, alpha: float = ALPHA, sweeps: int | None = None, share: float = SHARE, targets: dict[str, dict[str, float]] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, lang, topic, estimated_tokens, factor, probability, selected and the kept columns (as given) of every row.

    Nulls of a dimension are a class of their own, shown as ``~``. A repeated id has one draw;
    a null text has one token. ``topic`` is the topic's column; by default it is topic_of the
    text. Raking goes on until the marginals meet their targets, or for ``sweeps`` sweeps. An empty
    table gives no rows.
    """
    own = scope or session_scope(docs.sparkSession)
    text = F.col(text_column)
    named = docs.select(
        F.col(id_column).alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("~")).alias("source"),
        F.coalesce(F.col("lang").cast("string"), F.lit("~")).alias("lang"),
        F.coalesce(topic if topic is not None else topic_of(text), F.lit("~")).alias("topic"),
        token_weight(text).alias("tokens"),
        *([F.struct(*keep).alias("_kept")] if keep else []),
    ).withColumn("cell", F.to_json(F.struct(*DIMENSIONS)))
    cells = own.write(named.groupBy("cell", *DIMENSIONS).agg(F.count("*").alias("n"), F.sum("tokens").alias("tokens")), "cells")
    n_cells, total = cells.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    one = n_cells <= ONE_TASK
    if one:
        cells = cells.coalesce(1)
    raked = own.write(rake(cells, own, one, alpha, sweeps, targets), "raked-cells")
    solved = own.write(calibrate(raked, share).select("cell", "n", "factor", "probability"), "probabilities")
    if n_cells <= BROADCAST:
        out = named.join(F.broadcast(solved.drop("n")), "cell")
    else:
        out = join_to_unique(named, solved, "cell", total)
    selected = draw_of(F.col("doc_id")) < F.col("probability")
    return out.select("doc_id", *DIMENSIONS, F.col("tokens").alias("estimated_tokens"), "factor", "probability", selected.alias("selected"), *(["_kept"] if keep else []))


def mixing_sql(alpha: float = ALPHA, share: float = SHARE) -> str:
    """The same rows of the documents table, for DuckDB."""
    topic = f"(CASE WHEN contains(t, chr(10)) THEN 'lines' ELSE 'line' END || CASE WHEN length(t) < {SHORT} THEN '-short' WHEN length(t) < {LONG} THEN '-medium' ELSE '-long' END)"
    aims = ", ".join(f"to_{d}" for d in DIMENSIONS)
    ends = f"(n % {SWEEPS} = 0 AND (off <= {TOLERANCE} OR off > {STALLED} * before)) OR n >= {MOST_SWEEPS}"
    sweep = f"(SELECT * FROM r WHERE n = 0 OR NOT ({ends}))"
    for d in DIMENSIONS:
        sweep = f"(SELECT * REPLACE (weight * to_{d} / sum(weight) OVER (PARTITION BY {d}) AS weight) FROM {sweep})"
    off = "greatest(" + ", ".join(f"abs(sum(weight) OVER (PARTITION BY {d}) / to_{d} - 1)" for d in DIMENSIONS) + ")"
    return f"""WITH RECURSIVE named AS MATERIALIZED (
        SELECT doc_id, coalesce(source, '~') AS source, coalesce(lang, '~') AS lang, {topic} AS topic,
               CAST((strlen(t) + {BYTES_PER_TOKEN - 1}) // {BYTES_PER_TOKEN} + 1 AS BIGINT) AS estimated_tokens
        FROM (SELECT *, coalesce(text, '') AS t FROM documents)
    ), cells AS MATERIALIZED (
        SELECT source, lang, topic, sum(estimated_tokens)::DOUBLE AS tokens FROM named GROUP BY ALL
    ), marked AS MATERIALIZED (
        SELECT *, sum(tokens) OVER () AS everything, {", ".join(f"sum(tokens) OVER (PARTITION BY {d}) AS own_{d}" for d in DIMENSIONS)} FROM cells
    ), powered AS MATERIALIZED (
        SELECT *, {", ".join(f"pow(own_{d} / everything, {alpha}) AS p_{d}" for d in DIMENSIONS)} FROM marked
    ), start AS MATERIALIZED (
        SELECT source, lang, topic, tokens, tokens AS weight, {", ".join(f"p_{d} / sum(p_{d} * tokens / own_{d}) OVER () * everything AS to_{d}" for d in DIMENSIONS)} FROM powered
    ), r AS (
        SELECT 0 AS n, source, lang, topic, tokens, weight, {aims}, 'infinity'::DOUBLE AS off, 'infinity'::DOUBLE AS before FROM start
        UNION ALL
        SELECT n + 1 AS n, source, lang, topic, tokens, weight, {aims}, max(one_off) OVER () AS off, before
        FROM (SELECT * REPLACE (CASE WHEN n % {SWEEPS} = 0 THEN off ELSE before END AS before), {off} AS one_off FROM {sweep})
    ), f AS MATERIALIZED (
        SELECT source, lang, topic, tokens, weight / tokens AS factor FROM r WHERE n = (SELECT max(n) FROM r)
    ), ks AS MATERIALIZED (
        SELECT *, row_number() OVER o AS place,
               ({share} * sum(tokens) OVER () - coalesce(sum(tokens) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
               / sum(factor * tokens) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS k
        FROM f WINDOW o AS (ORDER BY factor DESC, source, lang, topic)
    ), best AS (
        SELECT arg_min(k, place) AS k FROM ks WHERE k * factor <= 1 + 1e-9
    ), solved AS (
        SELECT source, lang, topic, factor, least(1.0, best.k * factor) AS probability FROM f, best
    )
    SELECT doc_id, source, lang, topic, estimated_tokens, round(factor, 6) AS factor, round(probability, 6) AS probability,
           CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) / 4294967296.0 < probability AS selected
    FROM named JOIN solved USING (source, lang, topic)"""
