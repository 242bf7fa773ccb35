"""Column functions: time, business hours, text keys, deterministic ids, null-strict totals."""

from __future__ import annotations

import unicodedata
import uuid
from collections.abc import Callable
from datetime import date, timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CalendarSpec

HOUR, DAY = 3_600_000_000, 86_400_000_000
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def micros(at: str) -> Column:
    """Microseconds since 1970 of a TIMESTAMP_NTZ column that holds UTC."""
    return F.expr(f"timestampdiff(MICROSECOND, {_EPOCH}, {at})")


def local_micros(at: Column, zone: str) -> Column:
    """Microseconds of the local wall clock since 1970; the session's zone plays no part."""
    return F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(at), zone))


def _day_and_clock(at: Column, zone: str) -> tuple[Column, Column]:
    wall = local_micros(at, zone)
    clock = F.pmod(wall, F.lit(DAY))
    return ((wall - clock) / DAY).cast("int"), clock


def local_day(at: Column, zone: str) -> Column:
    return F.date_from_unix_date(_day_and_clock(at, zone)[0])


def _open_days(spec: CalendarSpec) -> tuple[int, int, Column]:
    """The first day of the calendar since 1970, its number of days, and its open days in blocks of 32 days.

    A block is one number: how many open days lie before it in the upper half, and which of its own days are open as the bits of
    the lower one.  The column is a constant of about 1,500 numbers, which the optimizer folds; it is part of every task.
    """
    closed, day, before, blocks, n = set(spec.holidays()), date(spec.years[0], 1, 1), 0, [], 0
    first = (day - date(1970, 1, 1)).days
    while day.year <= spec.years[1]:
        if n % 32 == 0:
            blocks.append(before << 32)
        if day.weekday() < 5 and day not in closed:
            blocks[-1] |= 1 << n % 32
            before += 1
        day, n = day + timedelta(days=1), n + 1
    return first, n, F.split(F.lit(" ".join(map(str, blocks))), " ").cast("array<bigint>")


def _business_until(at: Column, spec: CalendarSpec, first: int, size: int, blocks: Column) -> Column:
    """Business microseconds from the calendar's first day up to an instant; differences are durations."""
    day, clock = _day_and_clock(at, spec.zone)
    n = day - first
    block, place = F.get(blocks, F.when(n.between(0, size - 1), F.shiftright(n, 5))), F.pmod(n, F.lit(32))
    before = F.shiftright(block, 32) + F.bit_count(block.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), place) - 1))
    is_open = F.call_function("shiftright", block, place).bitwiseAND(F.lit(1).cast("long"))
    today = F.lit(0).cast("long")
    for a, b in spec.windows:
        today = today + F.greatest(F.lit(0), F.least(clock, F.lit(b * HOUR)) - F.lit(a * HOUR))
    return before * (sum(b - a for a, b in spec.windows) * HOUR) + is_open * today


def business_micros(start: Column, end: Column, spec: CalendarSpec = CalendarSpec()) -> Column:
    """Business time between two instants in microseconds; 0 if end <= start.

    Null if either is null or lies outside the calendar's years.
    """
    known = _open_days(spec)
    spent = _business_until(end, spec, *known) - _business_until(start, spec, *known)
    return F.when(spent.isNotNull(), F.greatest(F.lit(0), spent))


def strict_sum(value: Column) -> Column:
    """Sum that one unknown member makes unknown; 0 over no rows."""
    return F.when(F.count(F.lit(1)) == F.count(value), F.coalesce(F.sum(value), F.lit(0).cast("long")))


def uuid5(namespace: uuid.UUID, name: Column) -> Column:
    """Name-based UUID (version 5) as text; null for a null name."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), name.cast("binary")))
    variant = F.lower(F.hex(F.conv(F.substring(digest, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    text = F.concat_ws("-", F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.concat(F.lit("5"), F.substring(digest, 14, 3)), F.concat(variant, F.substring(digest, 18, 3)), F.substring(digest, 21, 12))
    return F.when(name.isNotNull(), text)


def sha_key(*parts: Column) -> Column:
    """SHA-256 of the parts as text joined by |; a null part is the text None."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("None")) for p in parts]), 256)


# Accented Latin letters and the plain letters that they fold to.
_ACCENTED = "áàâãäåçéèêëíìîïñóòôõöúùûüýÿ"
_PLAIN = "aaaaaaceeeeiiiinooooouuuuyy"


def _normalised(form: str, strip: bool) -> Callable[[pd.Series], pd.Series]:
    def one(text: str | None) -> str | None:
        if text is None:
            return None
        text = unicodedata.normalize(form, text)
        return "".join(c for c in text if not unicodedata.combining(c)).casefold() if strip else text

    return lambda values: values.map(one, na_action="ignore")


def composed(value: Column) -> Column:
    """Unicode NFC, in Arrow batches: Spark has no function for it."""
    return F.pandas_udf(_normalised("NFC", False), "string")(value)


def plain_letters(value: Column) -> Column:
    """NFKD without combining marks, case folded: what folded() does for Latin letters, for all of Unicode."""
    return F.pandas_udf(_normalised("NFKD", True), "string")(value)


def clean_text(value: Column) -> Column:
    """White space squeezed and trimmed; blank becomes null."""
    return F.nullif(F.trim(F.regexp_replace(value, r"\s+", " ")), F.lit(""))


def source_key(value: Column) -> Column:
    """Key of a name as its source writes it: clean and in lower case, accents kept."""
    return F.lower(clean_text(value))


def text_list(value: Column) -> Column:
    """The strings of a JSON array; null for anything else."""
    return F.from_json(value, "array<string>")


def list_text(values: Column) -> Column:
    """A JSON array of the distinct strings, sorted; an empty array for null."""
    return F.to_json(F.array_sort(F.array_distinct(F.coalesce(values, F.array().cast("array<string>")))))


def without_invalid(value: Column, marks: tuple[str, ...] = ("unknown", "deleted", "#")) -> Column:
    """A person's label, or null if it is blank or holds a mark of labels that name nobody."""
    text, bad = clean_text(value), F.lit(False)
    for m in marks:
        bad = bad | F.contains(F.lower(text), F.lit(m))
    return F.when(~bad, text)


def zoned_micros(value: Column) -> Column:
    """Microseconds of ISO text with a zone; text without one, and anything else, is null."""
    zoned = F.regexp_like(value, F.lit(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})$"))
    return F.when(zoned, F.unix_micros(F.try_to_timestamp(value)))


def iso_text(at: Column) -> Column:
    """Microseconds as ISO text in UTC, with six decimals and a Z."""
    day, clock = _day_and_clock(at, "UTC")
    seconds = F.floor(clock / 1_000_000)
    time = F.format_string("T%02d:%02d:%02d.%06dZ", F.floor(seconds / 3600), F.floor(seconds / 60) % 60, seconds % 60, clock % 1_000_000)
    return F.when(at.isNotNull(), F.concat(F.date_from_unix_date(day).cast("string"), time))


def first_time(**sources: Column) -> Column:
    """Struct at, source: the first of several times that is known, and which it is."""
    at, name = F.coalesce(*sources.values()), F.lit(None).cast("string")
    for key, column in reversed(sources.items()):
        name = F.when(column.isNotNull(), F.lit(key)).otherwise(name)
    return F.struct(at.alias("at"), name.alias("source"))


def folded(value: Column) -> Column:
    """Lower case without accents, white space squeezed."""
    return F.trim(F.regexp_replace(F.translate(F.lower(value), _ACCENTED, _PLAIN), r"\s+", " "))


def catalogue_key(value: Column) -> Column:
    return F.trim(F.regexp_replace(folded(value), "[^0-9a-z]+", " "))


def entity_key(value: Column) -> Column:
    """catalogue_key for all of Unicode: composed and decomposed letters, ligatures and full-width forms have one key."""
    return F.trim(F.regexp_replace(plain_letters(value), "[^0-9a-z]+", " "))


def event_micros(value: Column) -> Column:
    """Microseconds from Unix time as digits (10 s, 13 ms, 16 us, 17 of 100 ns, 19 ns), or null.

    Only instants from 2000 to 2100 count.
    """
    digits = F.when(F.regexp_like(value, F.lit("^[0-9]+$")), value)
    number = F.try_to_number(F.lpad(digits, 19, "0"), F.lit("9999999999999999999")).cast("decimal(38,0)")
    scale = {10: 1_000_000, 13: 1_000, 16: 1}
    out = F.lit(None).cast("long")
    for size, by in scale.items():
        out = F.when(F.length(digits) == size, (number * by).cast("long")).otherwise(out)
    for size, by in {17: 10, 19: 1000}.items():
        out = F.when(F.length(digits) == size, F.floor(number / by).cast("long")).otherwise(out)
    return F.when(out.between(946_684_800_000_000, 4_102_444_799_999_999), out)


def normal_url(value: Column) -> Column:
    """Scheme and host in lower case, for http and https; anything else is null."""
    scheme = F.lower(F.regexp_extract(value, "^([A-Za-z]+)://", 1))
    host = F.lower(F.regexp_extract(value, "^[A-Za-z]+://([^/?#]*)", 1))
    rest = F.regexp_extract(value, "^[A-Za-z]+://[^/?#]*(.*)$", 1)
    return F.when(scheme.isin("http", "https") & (host != ""), F.concat(scheme, F.lit("://"), host, rest))


def row_hash(columns: list[str]) -> Column:
    """A hash of a row's values by their columns' names, whatever the order of the columns."""
    return F.xxhash64(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}))


def fingerprint(df: DataFrame) -> DataFrame:
    """One row (n_rows, digest) that doesn't depend on the order of rows."""
    return df.agg(F.count("*").alias("n_rows"), F.coalesce(F.sum(row_hash(df.columns).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("digest"))
