"""Text functions of clips and transcripts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: clips that are nothing but one of these words are incomplete
FILLERS = ("uh", "um", "ah", "oh", "the", "and", "to", "a")


def strip(text: Column) -> Column:
    """Outer blanks off, Unicode ones too."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def word_count(text: Column) -> Column:
    """Words between Unicode blanks; null for null."""
    return F.size(F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")).cast("int")


def complete_words(text: Column) -> Column:
    """Whether a clip's text reads as whole words: no trailing or leading ellipsis, two words at least, no dangling article."""
    t = strip(text)
    bad = (t == "") | t.endswith("...") | t.startswith("...") | (word_count(t) < 2) | F.lower(t).isin(*FILLERS) | t.endswith(" the") | t.endswith(" a") | t.endswith(" and") | (t.startswith("the ") & (word_count(t) < 4))
    return ~bad


def clean_filename(name: Column) -> Column:
    """Reserved characters to underscores, runs of them to one, outer ones and blanks off; `unnamed` if nothing is left."""
    plain = F.regexp_replace(F.translate(name, '<>:"/\\|?*', "_" * 9), "_{2,}", "_")
    bare = F.trim(F.btrim(plain, F.lit("_")))
    return F.when(bare == "", "unnamed").otherwise(bare)


def episode_of_clip(name: Column) -> Column:
    """Clip name without extension, processing suffix and its last two parts (if it has three)."""
    parts = F.split(F.replace(F.regexp_replace(name, r"\.[^.]*$", ""), F.lit("_processed"), F.lit("")), "_")
    return F.when(F.size(parts) >= 3, F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 2, F.lit(1))), "_")).otherwise(F.array_join(parts, "_"))


def stamp(seconds: Column) -> Column:
    """MM:SS, minutes without bound."""
    return F.format_string("%02d:%02d", F.floor(seconds / 60).cast("long"), F.floor(F.pmod(seconds, F.lit(60.0))).cast("long"))


def frame_rate(ratio: Column) -> Column:
    """'n/d' as a number; 0 where that fails."""
    n, d = F.split_part(ratio, F.lit("/"), F.lit(1)), F.split_part(ratio, F.lit("/"), F.lit(2))
    return F.coalesce(F.try_divide(n.try_cast("double"), d.try_cast("double")), F.lit(0.0))


def archive_name(name: Column) -> Column:
    """Letters, digits, blanks, hyphens and underscores only; trailing blanks off, inner ones to underscores."""
    return F.replace(F.rtrim(F.regexp_replace(name, r"[^\p{L}\p{N} _-]", "")), F.lit(" "), F.lit("_"))
