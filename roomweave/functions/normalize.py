"""Column expressions that bring identifiers, paths and categories written in several ways to one form.

All stay on the JVM side; values that are already in the plain form take a short branch.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that are never part of an identifier: zero-width marks, joiners, soft hyphens.
INVISIBLE = "[\\u00ad\\u200b-\\u200f\\u2060\\ufeff]"
#: Outer white space, the no-break and wide kinds included.
SPACE = "[\\s\\u00a0\\u1680\\u2000-\\u200b\\u2028\\u2029\\u202f\\u205f\\u3000\\ufeff]"


def squeeze(c: Column) -> Column:
    """Without outer white space of any kind; null stays null."""
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def is_blank(c: Column) -> Column:
    return c.isNull() | c.rlike(f"^{SPACE}*$")


def scene_key(c: Column) -> Column:
    """Four digits, an underscore and six digits, however written (lost leading zeros are put back).

    A text that holds no such pair of numbers keeps its trimmed form; null stays null.
    """
    first = F.regexp_extract(c, "(\\d+)\\D+(\\d{6})(?!\\d)", 1)
    second = F.regexp_extract(c, "(\\d+)\\D+(\\d{6})(?!\\d)", 2)
    run = F.regexp_extract(c, "(?<!\\d)(\\d{10})(?!\\d)", 1)
    return (
        F.when(c.isNull() | c.rlike("^\\d{4}_\\d{6}$"), c)
        .when(second != "", F.concat(F.lpad(first, 4, "0"), F.lit("_"), second))
        .when(run != "", F.concat(F.substring(run, 1, 4), F.lit("_"), F.substring(run, 5, 6)))
        .otherwise(squeeze(c))
    )


def scan_key(c: Column) -> Column:
    """`SC` and seven digits however written; null for entries that name no scan."""
    digits = F.regexp_replace(c, "\\D", "")
    return F.when(F.upper(c).rlike("SC") & (F.length(digits) == 7), F.concat(F.lit("SC"), digits))


def id_key(c: Column) -> Column:
    """Lower-case letters and digits by part, parts joined by one underscore."""
    parts = F.regexp_replace(F.lower(F.regexp_replace(c, INVISIBLE, "")), "[^\\p{L}\\p{N}]+", "_")
    return F.when(c.isNull() | c.rlike("^[a-z0-9]+(_[a-z0-9]+)*$"), c).otherwise(F.regexp_replace(parts, "^_+|_+$", ""))


def category_key(c: Column) -> Column:
    """The category a value means: case, outer marks and the kind of word joint don't count; blank is null."""
    parts = F.regexp_replace(F.lower(F.regexp_replace(c, INVISIBLE, "")), "[^\\p{L}\\p{N}.]+", "_")
    plain = F.regexp_replace(parts, "^[_.]+|[_.]+$", "")
    number = f"^{SPACE}*[-+]?[0-9]+([.][0-9]+)?{SPACE}*$"
    return F.when(c.isNull() | c.rlike("^[a-z0-9]+(_[a-z0-9]+)*$"), c).when(c.rlike(number), squeeze(c)).otherwise(F.nullif(plain, F.lit("")))


def path_key(c: Column) -> Column:
    """A file path below the root: percent codes, back slashes, `.`, `..`, doubled and leading slashes resolved.

    Null and blank paths are null. A path with a malformed percent code is taken as it stands.
    """
    safe = F.regexp_replace(c, "\\+", "%2B")
    text = squeeze(F.regexp_replace(F.coalesce(F.try_url_decode(safe), c), "\\\\", "/"))
    steps = F.aggregate(
        F.split(text, "/"),
        F.array().cast("array<string>"),
        lambda done, step: F.when(step.isin("", "."), done)
        .when(step == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.array_append(done, step)),
    )
    plain = c.rlike("^[\\w-]+(/[\\w-]+)*/[\\w-]+\\.\\w+$")
    return F.when(is_blank(c), None).when(plain, c).otherwise(F.array_join(steps, "/"))


def pose_key(scene: Column, pattern: Column, index: Column) -> Column:
    """Scene, pattern and pose index as one key; null when the scene or the index is null."""
    return F.concat(scene_key(scene), F.lit("|"), F.coalesce(id_key(pattern), F.lit("")), F.lit("|"), index.cast("string"))


def record_key(scene: Column, pattern: Column, index: Column, question: Column) -> Column:
    """The name of a question record; null when its scene or pose index is null."""
    return F.concat(pose_key(scene, pattern, index), F.lit("|"), F.coalesce(id_key(question), F.lit("")))
