"""Model replies: fenced, commented or plain JSON text to VARIANT, and the detections inside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import coerce
from .geometry import clip_box, is_empty

#: Strings are kept (group 1); line comments end before the newline; an open block comment runs to the end.
COMMENTS = r'("(?:[^"\\]|\\[\s\S])*+(?:"|\\?\z))|//[^\n]*|/\*[\s\S]*?(?:\*/|\z)'
JSON_FENCE = r"(?s)```json\s*(.*?)```"
ANY_FENCE = r"(?s)```(.*?)```"
LIST_KEYS = ("detections", "objects", "results", "annotations")


def without_comments(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(COMMENTS), F.lit("$1"))


def fenced(text: Column) -> Column:
    """Content of the first closed json fence, else of the first closed fence, else the text."""
    return F.when(F.regexp_like(text, F.lit(JSON_FENCE)), F.regexp_extract(text, JSON_FENCE, 1)).when(F.regexp_like(text, F.lit(ANY_FENCE)), F.regexp_extract(text, ANY_FENCE, 1)).otherwise(text)


def strict(text: Column) -> Column:
    """VARIANT of a text that is one JSON value and nothing else, or null (parse_json itself stops after the first value)."""
    whole = F.try_parse_json(F.concat(F.lit('{"value":['), text, F.lit('],"end":1}')))
    single = lambda w: (F.try_variant_get(w, "$.end", "int") == 1) & F.try_variant_get(w, "$.value[1]", "variant").isNull()
    return coerce.let(whole, lambda w: F.when(single(w), F.try_variant_get(w, "$.value[0]", "variant")))


def parse(text: Column) -> Column:
    """VARIANT of a reply, or null: strict JSON first, then the fenced part without comments."""
    return F.coalesce(strict(text), strict(coerce.strip(without_comments(coerce.strip(fenced(text))))))


def checked(replies: DataFrame, text: str) -> DataFrame:
    """Replies with an error where there is none yet and the text does not parse."""
    lost = F.when(parse(F.col(text)).isNull(), F.lit("the reply does not parse"))
    return replies.withColumn("error", F.coalesce("error", lost))


def detection_items(v: Column) -> Column:
    """The list of detections: a list itself, the first list under a known key, or a single labelled box."""
    one = F.when(F.try_variant_get(v, "$.label", "variant").isNotNull() & F.try_variant_get(v, "$.bbox", "variant").isNotNull(), F.array(v))
    found = F.coalesce(F.try_variant_get(v, "$", "array<variant>"), *[F.try_variant_get(v, f"$.{k}", "array<variant>") for k in LIST_KEYS], one, F.array().cast("array<variant>"))
    return F.filter(found, lambda x: F.schema_of_variant(x).startswith("OBJECT"))


def detections(rows: DataFrame, text: str, *, width: str = "width", height: str = "height", min_score: float = 0.5, labels: tuple[str, ...] = coerce.LABELS) -> DataFrame:
    """Rows of rows with position, label, score, reason and bbox of every detection that passes.

    A detection passes with a known, allowed label, a score of min_score or more, and a box
    that is not empty once clipped to the tile. Replies that do not parse give no rows; list
    order is the position's order.
    """
    def one(item: Column, position: Column) -> Column:
        return F.struct(
            position.alias("position"),
            coerce.label(F.try_variant_get(item, "$.label", "string")).alias("label"),
            F.try_variant_get(item, "$.score", "double").alias("score"),
            F.coalesce(F.try_variant_get(item, "$.reason", "string"), F.lit("")).alias("reason"),
            coerce.let(coerce.bbox(F.try_variant_get(item, "$.bbox", "variant")), lambda b: clip_box(b, F.col(width), F.col(height))).alias("bbox"),
        )

    def passes(d: Column) -> Column:
        return d.label.isin(*labels) & (d.score >= min_score) & d.bbox.isNotNull() & ~is_empty(d.bbox)

    # inside higher-order functions each item is read once; a filter on columns would be pushed below and repeat the reading
    items = coerce.let(parse(F.col(text)), detection_items)
    return rows.select("*", F.inline(F.filter(F.transform(items, one), passes)))


def _truthy(v: Column, as_is: bool) -> Column:
    """The value, or null where it is empty, zero or false (kept as it is if as_is)."""
    if as_is:
        return v
    text, kind = F.try_variant_get(v, "$", "string"), F.schema_of_variant(v)
    falsy = ((kind == "BOOLEAN") & (text == "false")) | ((kind == "STRING") & (text == "")) | (F.coalesce(F.when(~kind.isin("STRING", "BOOLEAN"), F.try_variant_get(v, "$", "double")), F.lit(1.0)) == 0)
    return F.when(~falsy, v)


def region_reply(text: Column, as_is: bool = False) -> Column:
    """Struct of has_tree, score, tree_coverage and reason of a region reply; has_tree is null if the reply says nothing usable.

    Unless as_is, false, 0 and "" count as missing under each name, as the established replies' readers take them.
    """
    return coerce.let(parse(text), lambda v: _region_struct(v, as_is))


def _region_struct(v: Column, as_is: bool) -> Column:
    first = lambda *names: F.coalesce(*[_truthy(F.try_variant_get(v, f"$.{n}", "variant"), as_is) for n in names])
    has_tree = coerce.boolean(first("has_tree", "contains_trees", "tree_present", "tree_region"))
    score = F.coalesce(coerce.score(first("score", "confidence")), F.when(has_tree, 1.0).otherwise(0.0))
    return F.struct(has_tree.alias("has_tree"), score.alias("score"), coerce.score(first("tree_coverage", "coverage", "canopy_coverage")).alias("tree_coverage"), F.coalesce(F.try_variant_get(first("reason", "summary"), "$", "string"), F.lit("")).alias("reason"))
