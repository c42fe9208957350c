"""Coercions of loosely typed values (VARIANT columns) to labels, scores, booleans, boxes and polygons."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geometry import box

#: Names under which replies give the two labels.
LABEL_ALIASES = {
    "fallen_tree": "fallen_tree",
    "fall_tree": "fallen_tree",
    "tree_fall": "fallen_tree",
    "tree_fallen": "fallen_tree",
    "lodged_tree": "fallen_tree",
    "倒伏树木": "fallen_tree",
    "树木倒伏": "fallen_tree",
    "倒木": "fallen_tree",
    "倒伏": "fallen_tree",
    "diseased_tree": "diseased_tree",
    "tree_disease": "diseased_tree",
    "dead_tree": "diseased_tree",
    "declining_tree": "diseased_tree",
    "病害树木": "diseased_tree",
    "树木病害": "diseased_tree",
    "病树": "diseased_tree",
    "枯死木": "diseased_tree",
    "枯黄树木": "diseased_tree",
}
LABELS = ("fallen_tree", "diseased_tree")
TRUE_WORDS, FALSE_WORDS = ("true", "yes", "1", "y"), ("false", "no", "0", "n")


def let(value: Column, body) -> Column:
    """body(value), with value computed once however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def field(v: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(v, path, kind)


def type_of(v: Column, path: str = "$") -> Column:
    return F.schema_of_variant(F.try_variant_get(v, path, "variant"))


def label(text: Column) -> Column:
    """The label that a name stands for; null for unknown names and null."""
    names = F.create_map(*[F.lit(x) for kv in LABEL_ALIASES.items() for x in kv])
    return F.try_element_at(names, F.lower(strip(text)))


def score(v: Column) -> Column:
    """A number, numeric string or boolean as double, else null; not clamped."""
    return F.try_variant_get(v, "$", "double")


def boolean(v: Column) -> Column:
    """Booleans, the words for them, and the integers 0 and 1; else null."""
    kind, word = F.schema_of_variant(v), F.lower(strip(F.try_variant_get(v, "$", "string")))
    as_word = F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)
    whole = F.try_variant_get(v, "$", "bigint")
    return (  # one test of the type, then one reading of the value
        F.when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
        .when(kind == "STRING", as_word)
        .when(kind == "BIGINT", F.when(whole == 1, True).when(whole == 0, False))
    )


def bbox(v: Column) -> Column:
    """A box from four numbers, {x, y, width, height} or {x0, y0, x1, y1}.

    The first form that is recognised decides: where its numbers do not convert, the result is null.
    """
    four = F.try_variant_get(v, "$", "array<variant>")
    at = lambda i: F.try_variant_get(v, f"$[{i}]", "double")
    get = lambda k: F.try_variant_get(v, f"$.{k}", "double")
    has = lambda *ks: sum_and([F.try_variant_get(v, f"$.{k}", "variant").isNotNull() for k in ks])
    made = F.when(F.size(four) == 4, box(at(0), at(1), at(2), at(3))).when(has("x", "y", "width", "height"), box(get("x"), get("y"), get("x") + get("width"), get("y") + get("height"))).when(has("x0", "y0", "x1", "y1"), box(get("x0"), get("y0"), get("x1"), get("y1")))
    return let(made, lambda m: F.when(m.x0.isNotNull() & m.y0.isNotNull() & m.x1.isNotNull() & m.y1.isNotNull(), m))


def sum_and(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def polygon(v: Column) -> Column:
    """A list of two-number points; null as a whole if any point is not."""
    points = F.try_variant_get(v, "$", "array<array<double>>")
    fine = F.forall(points, lambda p: p.isNotNull() & (F.size(p) == 2) & p[0].isNotNull() & p[1].isNotNull())
    return F.when(fine, points)


def required_number(v: Column, task: Column) -> Column:
    """The number; an error that names the task for null."""
    return F.when(v.isNull(), F.raise_error(F.concat(F.lit("task "), F.coalesce(task.cast("string"), F.lit("null")), F.lit(": a box needs numbers"))).cast("double")).otherwise(v)


def first_label(labels: Column) -> Column:
    """The first of a rectangle's labels; null for none or an empty one."""
    return F.nullif(F.try_element_at(labels, F.lit(1)), F.lit(""))
