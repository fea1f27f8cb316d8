"""String columns: coercion, counting, error rate, names and sizes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def trimmed(c: Column) -> Column:
    """Without white space of any script at the ends; null is the empty string."""
    return F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"(?U)^\s+|\s+$", "")


def lowered(c: Column) -> Column:
    return F.lower(trimmed(c))


def visible_chars(c: Column) -> Column:
    """Code points that aren't white space of any script."""
    return F.length(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s", ""))


def char_error_rate(reference: Column, hypothesis: Column) -> Column:
    """Edits by code point over the reference's length; an empty reference gives 0 or 1."""
    ref, hyp = F.coalesce(reference, F.lit("")), F.coalesce(hypothesis, F.lit(""))
    empty = F.when(hyp == "", F.lit(0.0)).otherwise(F.lit(1.0))
    return F.when(ref == "", empty).otherwise(F.levenshtein(ref, hyp) / F.length(ref).cast("double"))


def to_number(c: Column) -> Column:
    """A double, null where the text isn't one."""
    return c.try_cast("double")


def scrubbed(c: Column) -> Column:
    """Null for NaN."""
    return F.when(~F.isnan(c), c)


def first_of(document: Column, names: Sequence[str]) -> Column:
    """The first alias of a JSON document that isn't null."""
    return F.coalesce(*(F.get_json_object(document, f"$.{n}") for n in names))


def padded(c: Column, width: int) -> Column:
    """Zero-padded to ``width``, never cut."""
    text = c.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def stem(path: Column) -> Column:
    """The base name without its last suffix."""
    return F.regexp_replace(base_name(path), r"(?<=.)\.[^.]*$", "")


def suffix(path: Column) -> Column:
    """Lower-case last suffix with its dot, empty if there is none."""
    return F.lower(F.regexp_extract(base_name(path), r".(\.[^.]*)$", 1))


def shortened(error: Column, size: int = 500) -> Column:
    return F.left(error, F.lit(size))


def tenths(n: Column, power: int) -> Column:
    """``n`` / 2**``power`` with one decimal; halves go to the even digit, as C and Python print them (Java's format rounds them up)."""
    unit = 1 << power
    rest = F.pmod(n, F.lit(unit)) * 10
    low, over = F.floor(rest / F.lit(unit)), F.pmod(rest, F.lit(unit)) * 2
    up = (over > unit) | ((over == unit) & (low % 2 == 1))
    all_tenths = F.floor(n / F.lit(unit)) * 10 + low + up.cast("long")
    return F.concat(F.floor(all_tenths / 10).cast("string"), F.lit("."), (all_tenths % 10).cast("string"))


def human_bytes(n: Column) -> Column:
    """Bytes by powers of 1024 with one decimal."""
    n = n.cast("long")
    out = F.concat(tenths(n, 40), F.lit(" TB"))
    for power, unit in ((30, "GB"), (20, "MB"), (10, "KB")):
        out = F.when(n < (1 << power + 10), F.concat(tenths(n, power), F.lit(f" {unit}"))).otherwise(out)
    return F.when(n < 1024, F.concat(n.cast("string"), F.lit(" B"))).otherwise(out)


def is_rate_limit(error: Column) -> Column:
    return F.lower(F.coalesce(error, F.lit(""))).rlike("429|throttl|rate limit|ratelimit|too many requests")


def iso_utc(moment: Column) -> Column:
    """A timestamp of the session's time zone as UTC with a Z."""
    return F.date_format(F.to_utc_timestamp(moment, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def utc_now() -> Column:
    return iso_utc(F.current_timestamp())


def file_stamp(iso: Column) -> Column:
    return F.translate(iso, ":-", "")


def content_hash(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def hash_fraction(*parts: Column | str) -> Column:
    """A number in [0, 1) that depends on the parts alone: the first 32 bits of their MD5."""
    joined = F.concat_ws("\x1f", *parts)
    return F.conv(F.left(F.md5(joined.cast("binary")), F.lit(8)), 16, 10).cast("double") / F.lit(float(1 << 32))


def hash_slot(c: Column, n: int) -> Column:
    """CRC-32 of the text modulo ``n``: the static worker of a task."""
    return (F.crc32(c.cast("binary")) % n).cast("int")
