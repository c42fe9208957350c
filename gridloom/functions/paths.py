"""Image paths of annotation tasks, and text pieces of exports and prompts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_PREFIX, UPLOAD_PREFIX = "/data/local-files/", "/data/upload/"


def _path(image: Column) -> Column:
    bare = F.regexp_replace(image, r"[?#].*$", "")
    return F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/]*", "")


def _local(image: Column) -> Column:
    """Decoded d parameter of a local-files reference."""
    raw = F.nullif(F.regexp_extract(image, r"[?&]d=([^&#]*)", 1), F.lit(""))
    return F.coalesce(F.try_url_decode(raw), raw)


def _join(root: str | None, relative: Column) -> Column:
    return relative if root is None else F.concat(F.lit(root.rstrip("/") + "/"), relative)


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def resolve_image(image: Column, local_root: str | None = None, upload_root: str | None = None) -> Column:
    """Path of a task's image: the local file named by d, the upload under its root, or the value unchanged."""
    path = _path(image)
    upload = F.substring(path, F.lit(len(UPLOAD_PREFIX) + 1), F.length(path))
    return F.when((path == LOCAL_PREFIX) & _local(image).isNotNull(), _join(local_root, _local(image))).when(path.startswith(UPLOAD_PREFIX), F.concat(F.lit("upload/"), upload) if upload_root is None else _join(upload_root, upload)).otherwise(image)


def subset_target(image: Column) -> Column:
    """Path of an image inside a subset; an error where there is none or it would leave the subset."""
    path = _path(image)
    rest = F.when(path == LOCAL_PREFIX, _local(image)).when(path.startswith(UPLOAD_PREFIX), F.concat(F.lit("upload/"), F.substring(path, F.lit(len(UPLOAD_PREFIX) + 1), F.length(path)))).otherwise(F.regexp_replace(path, "^/+", ""))
    bad = rest.isNull() | (rest == "") | rest.startswith("/") | F.array_contains(F.split(rest, "/"), "..")
    return F.when(bad, F.raise_error(F.concat(F.lit("no path inside the subset for "), F.coalesce(image, F.lit("null")))).cast("string")).otherwise(F.concat(F.lit("images/"), rest))


def source_candidates(image: Column, source_root: str, upload_root: str | None) -> Column:
    """Places where an image may lie, in order: its whole relative path, then its name alone."""
    path = _path(image)
    upload = F.substring(path, F.lit(len(UPLOAD_PREFIX) + 1), F.length(path))
    both = lambda root, rel: F.array(_join(root, rel), _join(root, basename(rel)))
    none = F.array().cast("array<string>")
    found = F.when(path == LOCAL_PREFIX, both(source_root, _local(image))).when(path.startswith(UPLOAD_PREFIX), none if upload_root is None else both(upload_root, upload)).otherwise(both(source_root, F.regexp_replace(path, "^/+", "")))
    return F.array_distinct(found)


def image_reference(path: Column, root_url: str | None) -> Column:
    return path if not root_url else F.concat(F.lit(root_url.rstrip("/") + "/"), basename(path))


#: Fixed value: one box slot of an assistant reply.
BOX_SLOT = '\t{"bbox_2d": <bbox>, "label": "<ref-object>"}'


def assistant_text(n: Column, slot: str = BOX_SLOT) -> Column:
    """A list with one slot for each box, [] for none."""
    return F.when(n <= 0, F.lit("[]")).otherwise(F.concat(F.lit("[\n"), F.array_join(F.array_repeat(F.lit(slot), n), ",\n"), F.lit("\n]")))


def references(label: Column, n: Column) -> Column:
    """The label once more than there are boxes; once for none."""
    return F.array_repeat(label, F.when(n > 0, n + 1).otherwise(1))


def progress(current: Column, total: Column) -> Column:
    share = F.round(current * 100.0 / F.when(total > 0, total), 1)
    return F.when(total <= 0, F.lit("0/0 (0.0%)")).otherwise(F.format_string("%d/%d (%.1f%%)", current, total, share))


def worth_logging(current: Column, total: Column) -> Column:
    """All of up to ten, the first and last, every tenth, and the first of each tenth of the total."""
    tenth = lambda c: F.floor(c * 10 / F.when(total > 0, total))
    return (total <= 10) | (current == 1) | (current == total) | (current % 10 == 0) | (tenth(current) != tenth(current - 1))


def region_prompt(width: Column, height: Column) -> Column:
    """The request for a region's verdict, naming its size."""
    return F.format_string(
        "This is a low-resolution aerial image of a region of %d x %d pixels. Decide whether it shows trees that are worth a closer look for dead or fallen ones.\n"
        "Say true for a clear canopy, a belt or group of trees or a wooded patch; say false where roads, water, bare ground, buildings or sparse shrubs prevail.\n"
        "Answer with one JSON object and nothing else: has_tree (boolean), score (0 to 1), tree_coverage (0 to 1), reason (short text).",
        width,
        height,
    )


#: What each label means, for prompts.
LABEL_NOTES = {"fallen_tree": "a visible tree that lies on the ground or leans far over, unlike the upright trees around it", "diseased_tree": "a visible tree whose crown is yellow, red, grey, thinned or partly dead"}
#: What is no target, for prompts.
TILE_RULES = (
    "Boxes are in pixels of this image.",
    "Report a box only where trunk, crown or the whole tree is clearly visible and the damage is the tree's own.",
    "Power towers, pylons, utility poles, wires, insulators, guy lines, tower bases, access tracks, tower shadows and cleared strips are never targets; nor are shapes, shadows, glare or bare ground near them.",
    "Where a power tower or wire is close and the damage cannot be told to be a tree's, report nothing.",
    "Without a sure target the list is empty.",
)


def tile_prompt(width: Column, height: Column, labels: tuple[str, ...] = tuple(LABEL_NOTES)) -> Column:
    """The request for detections in a tile, naming its size, the labels and what is no target."""
    notes = "".join(f"\n- {x}: {LABEL_NOTES.get(x, x)}" for x in labels)
    rules = "".join(f"\n{i}. {x}" for i, x in enumerate(TILE_RULES, 1))
    text = "Find damaged trees in this aerial image of %d x %d pixels. Labels:" + (notes + "\nRules:" + rules).replace("%", "%%")
    return F.format_string(text + '\nAnswer with one JSON object and nothing else: {"summary": "...", "detections": [{"label": "...", "score": 0 to 1, "bbox": [x0, y0, x1, y1], "reason": "..."}]}', width, height)
