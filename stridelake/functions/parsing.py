"""Column expressions that parse names, odds, dates, ids and lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Distance of the finish gate, metres in a furlong and yard, feet in a furlong.
FINISH_GATE, FURLONG_M, YARD_M, FURLONG_FT = 9999.0, 201.168, 0.9144, 660.0


def gate_number(col: Column) -> Column:
    """Furlongs of a gate name: ``6f`` 6, ``5.5f`` 5.5, ``5.5f5.5ft`` 5.5 and 5.5/660; ``finish`` the end; else null."""
    name = F.lower(F.trim(col))
    whole = r"^(\d+(?:\.\d+)?)f(?:(\d+(?:\.\d+)?)ft)?$"
    furlongs = F.regexp_extract(name, whole, 1).try_cast("double")
    feet = F.coalesce(F.regexp_extract(name, whole, 2).try_cast("double"), F.lit(0.0))
    return F.when(name == "finish", F.lit(FINISH_GATE)).otherwise(furlongs + feet / FURLONG_FT)


def odds_to_prob(col: Column) -> Column:
    """Probability of fractional odds: ``10/1`` is 1 / (10 / 1 + 1); null if not odds or over nothing."""
    top = F.regexp_extract(col, r"^\s*(\d+(?:\.\d+)?)\s*/\s*\d", 1).try_cast("double")
    bottom = F.regexp_extract(col, r"/\s*(\d+(?:\.\d+)?)\s*$", 1).try_cast("double")
    return F.try_divide(F.lit(1.0), F.try_divide(top, bottom) + 1)


def parse_date(col: Column, formats: Sequence[str] = ("yyyy-MM-dd", "yyyyMMdd", "MM/dd/yyyy"), default: str | None = None) -> Column:
    """Date by the first format that fits, else the default."""
    tried = [F.try_to_timestamp(col, F.lit(f)).cast("date") for f in formats]
    return F.coalesce(*tried, F.lit(default).cast("date"))


def parse_time(col: Column, formats: Sequence[str] = ("HH:mm:ss", "HH:mm", "h:mma")) -> Column:
    """Time of day as HH:mm:ss text by the first format that fits."""
    tried = [F.try_to_timestamp(F.concat(F.lit("1970-01-01 "), col), F.lit(f"yyyy-MM-dd {f}")) for f in formats]
    return F.date_format(F.coalesce(*tried), "HH:mm:ss")


def parse_duration(col: Column) -> Column:
    """Seconds of ``m:ss.ff`` or ``ss.ff``; null if neither."""
    parts = F.split(F.trim(col), ":")
    last = F.element_at(parts, -1).try_cast("double")
    minutes = F.when(F.size(parts) == 2, F.get(parts, F.lit(0)).try_cast("double")).when(F.size(parts) == 1, F.lit(0.0))
    return minutes * 60 + last


def race_identifier(course: Column, date: Column, number: Column) -> Column:
    """Base64 of course (3 letters, padded), yyyyMMdd and a two-digit number."""
    return F.base64(F.encode(F.concat(F.rpad(F.upper(course), 3, " "), F.date_format(date, "yyyyMMdd"), F.lpad(number.cast("string"), 2, "0")), "UTF-8"))


def decode_race_identifier(col: Column) -> Column:
    """Struct of course, date and number of a race identifier."""
    text = F.decode(F.unbase64(col), "UTF-8")
    return F.struct(F.trim(F.substring(text, 1, 3)).alias("course"), F.try_to_timestamp(F.substring(text, 4, 8), F.lit("yyyyMMdd")).cast("date").alias("date"), F.substring(text, 12, 2).try_cast("int").alias("number"))


def safe_num(col: Column, kind: str = "double", max_abs: float | None = None, default: float | None = None) -> Column:
    """Number of a text; ``NA``, blanks, nonsense and values over a bound become the default."""
    text = F.trim(col.cast("string"))
    value = F.when(F.upper(text).isin("NA", ""), None).otherwise(text).try_cast(kind)
    if max_abs is not None:
        value = F.when(F.abs(value) < max_abs, value)
    return value if default is None else F.coalesce(value, F.lit(default).cast(kind))


def parse_winners(col: Column) -> Column:
    """``6-1/4/7-5`` as legs of tied winners: [[6], [1, 4, 7], [5]]; a blank has none."""
    legs = F.transform(F.split(col, "-"), lambda leg: F.transform(F.split(leg, "/"), F.trim))
    return F.when(F.trim(col) == "", F.array().cast("array<array<string>>")).otherwise(legs)


def clean_text(col: Column, n: int) -> Column:
    """Letters, digits, underscores and blanks only, cut to n characters, trimmed."""
    return F.trim(F.left(F.regexp_replace(col, r"[^\w\s]", ""), F.lit(n)))


def cloth_number(col: Column) -> Column:
    """Saddle cloth of a feed id: its last two characters without blanks or a leading zero."""
    return F.regexp_replace(F.regexp_replace(F.right(col, F.lit(2)), r"\s", ""), "^0", "")


def points_of_call(col: Column) -> Column:
    """Calls of an XML fragment as an array of structs (name, position, lengths)."""
    schema = "poc array<struct<_name:string,position:int,lengths:double>>"
    return F.from_xml(col, schema)["poc"]


def points_of_call_json(col: Column) -> Column:
    """The same as JSON text."""
    return F.to_json(points_of_call(col))


def age_years(day: Column, born: Column) -> Column:
    """Days between, over 365.25."""
    return F.datediff(day, born) / F.lit(365.25)


def epoch_days(col: Column) -> Column:
    """Days since 1970-01-01."""
    return F.unix_date(col.cast("date"))


def add_seconds(ts: Column, seconds: Column) -> Column:
    """A timestamp and fractional seconds; null seconds give null."""
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def same_set(a: Column, b: Column) -> Column:
    """Whether two arrays hold the same items in any order."""
    return F.array_sort(a) == F.array_sort(b)


def pad_array(col: Column, n: int, filler: Column, side: str = "right") -> Column:
    """An array of exactly n items: cut at the end, or filled at one side."""
    fill = F.array_repeat(filler, n)
    if side == "right":
        return F.slice(F.concat(col, fill), 1, n)
    return F.slice(F.concat(fill, F.slice(col, 1, n)), F.least(F.size(col), F.lit(n)) + 1, n)


def safe_name(name: str) -> str:
    """A model's file name as a column name."""
    kept = "".join(c if c.isalnum() else "_" for c in name.rsplit("/", 1)[-1].rsplit(".", 1)[0])
    return f"m_{kept}" if kept[:1].isdigit() else kept


def expand_array(df: DataFrame, col: str, n: int, prefix: str) -> DataFrame:
    """An array's first n items as columns prefix1 .. prefixn; missing ones are null."""
    return df.withColumns({f"{prefix}{i + 1}": F.get(col, F.lit(i)) for i in range(n)})


def flatten_array(col: Column) -> Column:
    """A nested array as one array."""
    return F.flatten(col)


def distance_meters(dist: Column, unit: Column, round_: bool = True) -> Column:
    """Metres of a distance: F hundredths of furlongs, M metres, Y yards; else null."""
    metres = F.when(F.upper(unit) == "F", dist / 100 * FURLONG_M).when(F.upper(unit) == "M", dist.cast("double")).when(F.upper(unit) == "Y", dist * YARD_M)
    return F.round(metres) if round_ else metres


def race_id(course: Column, date: Column, number: Column, pad: bool = False) -> Column:
    """course_date_number, plain or with the number as two digits."""
    text = number.cast("string")
    return F.concat_ws("_", course, F.date_format(date, "yyyy-MM-dd"), F.lpad(text, 2, "0") if pad else text)


def condition_bucket(surface: Column, condition: Column, metres: Column, kind: Column, muddy: str = "MY", bound: float = 1409.0, types_first: bool = False) -> Column:
    """Statistic bucket of a race: its surface, or its type, and sprint or route.

    A distance of exactly the bound is a sprint. By default the surface decides, so
    that dirt races of a type are dirt races; ``types_first`` lets the type decide.
    """
    by_surface = F.when((surface == "D") & (condition == muddy), "MUDDY").when(surface == "D", "DIRT").when(surface == "T", "TURF").when(surface == "A", "ALL_WEATHER")
    by_type = F.when((surface == "D") & kind.isin("Allowance", "Claiming", "Stakes"), F.upper(kind))
    head = F.coalesce(by_type, by_surface) if types_first else F.coalesce(by_surface, by_type)
    return F.concat(head, F.when(metres <= bound, "_SPRNT").when(metres > bound, "_RTE"))
