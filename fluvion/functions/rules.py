"""Text rules: names, years, paths, log lines. All are built-in expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def ordered_rules(rules: list[tuple[Column, object]], rest: object) -> Column:
    """The value of the first rule that holds; a null answer does not hold."""
    return reduce(lambda c, r: c.when(r[0], F.lit(r[1])), rules[1:], F.when(rules[0][0], F.lit(rules[0][1]))).otherwise(F.lit(rest))


def flags(rules: dict[str, Column], separator: str = "; ") -> Column:
    """Names of all rules that hold, joined; empty if none does."""
    return F.concat_ws(separator, *[F.when(c, F.lit(n)) for n, c in rules.items()])


def normal_name(name: Column) -> Column:
    """Lower-case letters and digits, all other runs as one space, trimmed; null counts as empty."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), "[^a-z0-9]+", " "))


def year_of_name(name: Column) -> Column:
    """The year of a file named ``*_<year>.nc``; null without one."""
    return F.when(name.rlike("_[0-9]{4}[.]nc$"), F.regexp_extract(name, "_([0-9]{4})[.]nc$", 1).cast("int"))


def years_of_list(text: Column) -> Column:
    """Years of a list such as ``1901-1903,1910`` as an ascending array; parts that are no year or span are left out."""
    span = lambda p: F.sequence(F.regexp_extract(p, "^([0-9]{4})", 1).cast("int"), F.regexp_extract(p, "([0-9]{4})$", 1).cast("int"))
    parts = F.filter(F.split(F.regexp_replace(text, r"\s", ""), ","), lambda p: p.rlike("^[0-9]{4}(-[0-9]{4})?$"))
    return F.array_sort(F.array_distinct(F.flatten(F.transform(parts, span))))


def human_size(size: Column) -> Column:
    """A byte count with one decimal and a binary unit."""
    units = ["B", "KiB", "MiB", "GiB", "TiB"]
    rules = [(size < 1024 ** (i + 1), F.format_string("%.1f " + u, size / float(1024**i))) for i, u in enumerate(units[:-1])]
    return reduce(lambda c, r: c.when(*r), rules[1:], F.when(*rules[0])).otherwise(F.format_string("%.1f TiB", size / float(1024**4)))


def glob_pattern(glob: str) -> str:
    """A regular expression for a file-name pattern with * ? and [...]."""
    import fnmatch

    return fnmatch.translate(glob).replace(r"\Z", "$").replace(r"\z", "$")


def any_glob(name: Column, globs: list[str]) -> Column:
    """Whether a base name matches one of the patterns."""
    return reduce(lambda a, b: a | b, [name.rlike("^" + glob_pattern(g)) for g in globs], F.lit(False))


#: Texts that stand for no answer. Fixed values.
MISSING_TEXT = ("", "na", "nan", "none")


def filled(text: Column) -> Column:
    """Whether a text says anything."""
    return F.coalesce(~F.lower(F.trim(text)).isin(*MISSING_TEXT), F.lit(False))


def purpose(texts: list[Column]) -> Column:
    """``supply`` if any text names irrigation or water supply, ``no_supply`` if any says something else, ``unknown`` if none says anything."""
    names = reduce(lambda a, b: a | b, [filled(t) & F.lower(t).rlike("irrigation|water supply") for t in texts])
    known = reduce(lambda a, b: a | b, [filled(t) for t in texts])
    return F.when(names, "supply").when(known, "no_supply").otherwise("unknown")


def capacity_choice(first: Column, second: Column, regulated: Column, area: Column, height: Column, band: tuple[float, float] = (0.05, 1.0)) -> Column:
    """Which of two capacities to take, and why: ``second:C1`` at a regulated lake; the one whose mean depth alone lies within ``band`` of the height (C2); else ``first:C3``."""
    fits = lambda c: F.coalesce((area > 0) & (height > 0) & (c / area).between(band[0] * height, band[1] * height), F.lit(False))
    lake = F.coalesce(F.lower(F.trim(regulated)).isin("yes", "enlarged"), F.lit(False))
    return F.when(lake, "second:C1").when(fits(second) & ~fits(first), "second:C2").when(fits(first) & ~fits(second), "first:C2").otherwise("first:C3")


def location_choice(fit_first: Column, fit_second: Column, most: float = 1.5) -> Column:
    """``second:L1`` if the second point's area fits, ``first:L2`` if only the first's does, ``second:L3`` if neither."""
    return F.when(F.coalesce(fit_second <= most, F.lit(False)), "second:L1").when(F.coalesce(fit_first <= most, F.lit(False)), "first:L2").otherwise("second:L3")


#: Years that stand for always and never. Fixed values.
ALWAYS, NEVER = 0, 9999


def scenario_year(year: Column, future: Column, scenario: str) -> Column:
    """The first year an item counts: its own in ``histsoc``; always or never in the fixed scenarios ``1850soc`` (built by then) and ``2021soc`` (not of the future)."""
    own = F.when(future, NEVER).otherwise(year)
    if scenario == "histsoc":
        return own
    if scenario == "1850soc":
        return F.when(~future & (own <= 1850), ALWAYS).otherwise(NEVER)
    if scenario == "2021soc":
        return F.when(future, NEVER).otherwise(ALWAYS)
    raise ValueError(f"unknown scenario {scenario}")


def period_of(year: Column, periods: list[tuple[str, int, int]]) -> Column:
    """Name of the first period (name, first, last) that holds a year; null outside all."""
    return F.coalesce(*[F.when(year.between(a, b), F.lit(n)) for n, a, b in periods])


def raised_to(value: Column, on: Column, floor: float) -> Column:
    """A value below ``floor`` raised to it where ``on`` holds; missing values stay missing."""
    return F.when(on & (value < floor), F.lit(floor)).otherwise(value)


def selected(name: Column, include: list[str], exclude: list[str]) -> Column:
    """Whether a base name is kept: not excluded, or included in spite of that. Patterns are those of file names."""
    return ~any_glob(name, exclude) | any_glob(name, include)


def run_id(*parts: Column) -> Column:
    """Parts of a run's name joined by an underscore; parts that are missing or empty are left out."""
    return F.concat_ws("_", *[F.when(p != "", p) for p in parts])


def chunks_of(first: Column, last: Column, length: int) -> Column:
    """Spans (start, end) of ``length`` years from first to last, the last one cut short; empty if first is after last."""
    span = lambda y: F.struct(y.alias("start"), F.least(y + length - 1, last).alias("end"))
    return F.when(first <= last, F.transform(F.sequence(first, last, F.lit(length)), span)).otherwise(F.array().cast("array<struct<start:int,end:int>>"))


def restamped(day: Column, year: Column) -> Column:
    """The same day of the year in another year; the 366th becomes the last where that year has 365."""
    first = F.make_date(year, F.lit(1), F.lit(1))
    last = F.make_date(year, F.lit(12), F.lit(31))
    return F.least(F.date_add(first, F.dayofyear(day) - 1), last)


def replaced_in(record: Column, schema: str, old: str, new: str) -> Column:
    """A record of any nesting with ``old`` replaced by ``new`` in every text of it."""
    return F.from_json(F.replace(F.to_json(record), F.lit(old), F.lit(new)), schema)


def utc_stamp(time: Column) -> Column:
    """A time as ``2024-01-31T07:05:09Z``, in the session's zone, which is set to UTC."""
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def dataset_of(name: Column) -> list[Column]:
    """Round, scenario, quantity and statistic out of ``<round>_<scenario>_<quantity>_<statistic>...``; nulls where a name has another form."""
    pattern = r"^([a-z0-9]+)_([a-z0-9-]+)_([a-z0-9-]+)_([a-z0-9-]+)"
    return [F.when(name.rlike(pattern), F.regexp_extract(name, pattern, k)).alias(n) for k, n in enumerate(("round", "scenario", "quantity", "statistic"), 1)]


def source_year(scenario: Column, year: Column, spans: dict[str, tuple[int, int]], constant: list[str]) -> Column:
    """The year that a file's data come from: its own inside the scenario's span, the span's first in a constant scenario; any other is an error."""
    bad = F.raise_error(F.concat(F.lit("no data of "), scenario, F.lit(" for "), year)).cast("int")
    own = [F.when((scenario == n) & year.between(a, b), year) for n, (a, b) in spans.items()]
    first = [F.when(scenario == n, F.lit(spans[n][0])) for n in constant]
    return F.coalesce(*own, *first, bad)
