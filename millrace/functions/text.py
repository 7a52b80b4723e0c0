"""Caption and label text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize(text: Column) -> Column:
    """Lower case, runs of non-ASCII characters and of white space as one blank, no blanks at the ends."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), r"[^\x00-\x7F]+", " "), r"\s+", " "))


def contains_any(text: Column, keywords: list[str]) -> Column:
    """Whether the lower-cased text has one of the keywords as a substring."""
    low = F.lower(text)
    found = F.lit(False)
    for k in keywords:
        found = found | F.contains(low, F.lit(k.lower()))
    return found


def caption_passes(text: Column, keywords: list[str], include: bool) -> Column:
    """Captions that have (include) or have not a keyword; missing and blank ones pass."""
    blank = text.isNull() | (F.trim(text) == "")
    hit = contains_any(text, keywords)
    return blank | (hit if include else ~hit)


def has_word(text: Column, words: list[str]) -> Column:
    """Whether one of the words occurs as a whole word."""
    return text.rlike(r"\b(" + "|".join(re.escape(w) for w in words) + r")\b")


def restore_allowed(censored: Column, original: Column, allowed: list[str]) -> Column:
    """Words of the original, in place of censored ones, where they are allowed once punctuation is dropped."""
    bare = lambda w: F.lower(F.regexp_replace(w, r"[^A-Za-z0-9 ]", ""))
    pick = F.zip_with(F.split(censored, " "), F.split(original, " "), lambda c, o: F.when(bare(o).isin(*allowed), o).otherwise(c))
    return F.array_join(pick, " ")


def caption_style(key: Column, kind: str) -> Column:
    """What is left of a caption key without its type and underscores; `long` if nothing is."""
    rest = F.replace(F.replace(key, F.lit(kind), F.lit("")), F.lit("_"), F.lit(""))
    known = rest.isin("", "short", "medium", "user", "long")
    return F.when(~known, F.raise_error(F.concat(F.lit("unknown caption style "), rest))).when(rest == "", "long").otherwise(rest)


def parse_bool(text: Column) -> Column:
    """yes, true, t, y and 1, no, false, f, n and 0, in any case; null for others."""
    low = F.lower(text)
    return F.when(low.isin("yes", "true", "t", "y", "1"), True).when(low.isin("no", "false", "f", "n", "0"), False)


def command_from_name(name: Column) -> Column:
    """The words of a file name after its last part that has SCENE, joined by blanks."""
    base = F.regexp_replace(F.substring_index(name, "/", -1), r"\.[A-Za-z0-9]+$", "")
    return F.replace(F.regexp_replace(base, r"^.*SCENE[^_]*_", ""), F.lit("_"), F.lit(" "))


def json_first(doc: Column, paths: list[str]) -> Column:
    """The first of several JSON paths that is there."""
    return F.coalesce(*[F.get_json_object(doc, p) for p in paths])


def command_from_keywords(name: Column, commands: dict[str, str]) -> Column:
    """The command of the first keyword, in order, that the name contains; a name with none is an error."""
    out = F
    for k, v in commands.items():
        out = out.when(F.contains(name, F.lit(k)), v)
    return out.otherwise(F.raise_error(F.concat(F.lit("no command for "), name)))


def suite_from_path(path: Column, names: list[str]) -> Column:
    """The first of the names that is the path's first part, or else that the path contains; null for none."""
    first = F.split(path, "/")[0]
    inside = [F.when(F.contains(path, F.lit(n)), F.lit(n)) for n in names]
    return F.coalesce(F.when(first.isin(*names), first), *inside)


def repaired_json(doc: Column) -> Column:
    """JSON with braces around it where they are missing."""
    return F.when(F.startswith(F.ltrim(doc), F.lit("{")), doc).otherwise(F.concat(F.lit("{"), doc, F.lit("}")))


def merge_maps(left: Column, right: Column) -> Column:
    """One map; keys of both have the right one's value."""
    only = F.map_filter(left, lambda k, _: ~F.coalesce(F.map_contains_key(right, k), F.lit(False)))
    return F.map_concat(only, F.coalesce(right, F.create_map().cast("map<string,string>")))
