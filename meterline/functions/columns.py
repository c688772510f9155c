"""Scalar rules as column expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ID_WIDTH = 20


def lookup(value: Column, table: dict) -> Column:
    """Maps a value by a small fixed table; what isn't in it becomes null."""
    items: list[Column] = []
    for k, v in table.items():
        items += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*items), value)


def pad_id(value: Column, width: int = ID_WIDTH) -> Column:
    """Trimmed and padded with zeros on the left; a longer id is kept whole."""
    bare = F.trim(value)
    return F.when(F.length(bare) < width, F.lpad(bare, width, "0")).otherwise(bare)


def unpad_id(value: Column) -> Column:
    return F.regexp_replace(value, "^0+(?=.)", "")


def file_stem(path: Column, default: str = "UNKNOWN") -> Column:
    """The last part of a path, up to its first dot (a leading dot is part of the name); default for null or empty."""
    last = F.substring_index(path, "/", -1)
    return F.when(F.length(path) > 0, F.regexp_extract(last, r"^(.[^.]*|)", 1)).otherwise(F.lit(default))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed a single time however often it occurs there."""
    return F.element_at(F.transform(F.array(value), use), 1)


def name_part(name: Column, first: int = 2, last: int = 3, sign: str = "_") -> Column:
    """Parts first to last (from 1) of a name cut at a sign; all parts there are if it has fewer than last."""
    head = F.substring_index(name, sign, last)
    return F.array_join(F.slice(F.split(head, f"\\Q{sign}\\E"), first, last - first + 1), sign)


def bucket(key: Column, n: int) -> Column:
    """A stable bucket from 0 to n - 1."""
    return (F.crc32(key.cast("string")) % n).cast("int")


def uuid_from_parts(prefix: Column, number: Column) -> Column:
    """The UUID text of (prefix << 64) + number."""
    h = F.lower(F.concat(F.lpad(F.hex(prefix.cast("long")), 16, "0"), F.lpad(F.hex(number.cast("long")), 16, "0")))
    return F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def parts_from_uuid(uuid: Column) -> tuple[Column, Column]:
    h = F.replace(uuid, F.lit("-"), F.lit(""))
    return tuple(F.conv(F.substring(h, a, 16), 16, 10).cast("long") for a in (1, 17))


def generalize_tag(tag: Column) -> Column:
    t = F.lower(tag)
    return F.when(t.contains("eher"), "EHER").when(t.contains("hba"), "HBA").when(t.contains("challenge") | t.contains("production"), "CHALLENGE").otherwise("OTHER")


def keyword_flag(text: Column, words: Iterable[str], priority: Column | None = None, below: int = 8) -> Column:
    """1 if the text has one of the words (any case), else 0; null where the priority is not below its gate."""
    flag = F.lower(text).rlike("|".join(words)).cast("int")
    return flag if priority is None else F.when(priority < below, flag)


def profile_flag(value: Column, priority: Column, yes: str = "true", below: int = 3) -> Column:
    """1 or 0 by a class label; null where the label is or its priority isn't below the gate."""
    return F.when(value.isNotNull() & (priority < below), F.when(value == yes, 1).otherwise(0))


def zip5(postal: Column) -> Column:
    return F.substring(postal, 1, 5)


def band(score: Column, cuts: Iterable[tuple[float, str]], otherwise: str) -> Column:
    """The name of the first cut that the score reaches; null scores have no band."""
    out = None
    for at, name in cuts:
        out = F.when(score >= at, name) if out is None else out.when(score >= at, name)
    return F.when(score.isNotNull(), out.otherwise(otherwise))


def json_path(value: Column, path: str, kind: str) -> Column:
    """A number or text from a column that holds JSON text or a struct (kind: its data type's name)."""
    return F.get_json_object(value if kind == "string" else F.to_json(value), path)
