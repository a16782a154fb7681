"""Period tokens (year, semester, quarter, month, week, date) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colonnade.functions import fixed


def _part(token: Column, granularity: str, part: str) -> Column:
    """One number of a period token, from the first pattern of the granularity that matches."""
    found = [
        F.nullif(F.regexp_extract(token, pattern, groups[part]), F.lit(""))
        for pattern, groups in fixed.PERIOD_PATTERNS[granularity]
    ]
    return F.coalesce(*found).cast("int")


def _day(year: Column, month: Column, day: Column) -> Column:
    """Date from its parts; null when the calendar has no such day."""
    return F.format_string("%04d-%02d-%02d", year, month, day).try_cast("date")


def period_bounds(granularity: str, parts: dict[str, Column]) -> tuple[Column, Column]:
    """First and last day of a period; null for weeks and days that do not exist."""
    year = parts["y"]
    if granularity == "year":
        return _day(year, F.lit(1), F.lit(1)), _day(year, F.lit(12), F.lit(31))
    if granularity in ("quarter", "semester", "month"):
        months = {"quarter": 3, "semester": 6, "month": 1}[granularity]
        index = parts[{"quarter": "q", "semester": "s", "month": "m"}[granularity]]
        start = _day(year, (index - 1) * months + 1, F.lit(1))
        return start, F.last_day(F.add_months(start, months - 1))
    if granularity == "week":
        week = parts["w"]
        first = F.date_trunc("week", _day(year, F.lit(1), F.lit(4))).cast("date")
        monday = F.date_add(first, (week - 1) * 7)
        start = F.when(F.weekofyear(monday) == week, monday)
        return start, F.date_add(start, 6)
    day = _day(year, parts["m"], parts["d"])
    return day, day


def period_label(granularity: str, parts: dict[str, Column]) -> Column:
    """Normal text form of a period."""
    if granularity == "year":
        return F.format_string("%04d", parts["y"])
    if granularity == "quarter":
        return F.format_string("%04d-Q%d", parts["y"], parts["q"])
    if granularity == "semester":
        return F.format_string("%04d-S%d", parts["y"], parts["s"])
    if granularity == "month":
        return F.format_string("%04d-%02d", parts["y"], parts["m"])
    if granularity == "week":
        return F.format_string("%04d-W%02d", parts["y"], parts["w"])
    return F.format_string("%04d-%02d-%02d", parts["y"], parts["m"], parts["d"])


def parse_period(token: Column, granularity: str) -> Column:
    """Struct(start, end, label) for a token read at one granularity; null when it holds no such period."""
    names = fixed.PERIOD_PATTERNS[granularity][0][1]
    parts = {name: _part(token, granularity, name) for name in names}
    start, end = period_bounds(granularity, parts)
    return F.when(
        start.isNotNull(),
        F.struct(start.alias("start"), end.alias("end"), period_label(granularity, parts).alias("label")),
    )


def with_period(df: DataFrame, token: str, granularity: str | Column) -> DataFrame:
    """Replace a token column by the period it holds (start, end, label); rows without a period are left out.

    The granularity is a name, or a column that holds one.  The numbers of the token are columns of their own, so that
    each pattern is searched once per row.
    """
    names = tuple(fixed.PERIOD_PATTERNS) if isinstance(granularity, Column) else (granularity,)

    def choose(values: dict[str, Column]) -> Column:
        if not isinstance(granularity, Column):
            return values[granularity]
        chosen = None
        for name, value in values.items():
            chosen = F.when(granularity == name, value) if chosen is None else chosen.when(granularity == name, value)
        return chosen

    parts = {name: tuple(fixed.PERIOD_PATTERNS[name][0][1]) for name in names}
    numbers = {
        f"_{part}": choose({name: _part(F.col(token), name, part) for name in names if part in parts[name]})
        for part in dict.fromkeys(p for ps in parts.values() for p in ps)
    }
    columns = {name: {p: F.col(f"_{p}") for p in ps} for name, ps in parts.items()}
    found = df.withColumns(numbers).withColumn("start", choose({n: period_bounds(n, c)[0] for n, c in columns.items()}))
    dated = found.where("start IS NOT NULL").withColumns(
        {
            "end": choose({n: _last_day(n, F.col("start")) for n in names}),
            "label": choose({n: period_label(n, c) for n, c in columns.items()}),
        }
    )
    return dated.drop(token, *numbers)


def _last_day(granularity: str, start: Column) -> Column:
    """Last day of the period that starts on a day."""
    if granularity in ("date", "week"):
        return F.date_add(start, 0 if granularity == "date" else 6)
    months = {"year": 12, "semester": 6, "quarter": 3, "month": 1}[granularity]
    return F.last_day(F.add_months(start, months - 1))


def file_name_periods(text: Column) -> Column:
    """Array of struct(granularity, value) for the periods named in a file name, most specific kind first."""
    spaced = F.regexp_replace(text, r"[_\-]+", " ")
    hits = []
    for granularity in fixed.FILE_NAME_GRANULARITIES:
        label = parse_period(spaced, granularity)["label"]
        hits.append(F.when(label.isNotNull(), F.struct(F.lit(granularity).alias("granularity"), label.alias("value"))))
    return F.array_distinct(F.array_compact(F.array(*hits)))


def column_name_period(key: Column) -> Column:
    """Most specific granularity named in a normalised column name, as struct(granularity, confidence)."""
    ranked = []
    for order, (granularity, patterns) in enumerate(fixed.PERIOD_PATTERNS.items()):
        named = F.lit(False)
        for pattern, _ in patterns:
            named = named | key.rlike(pattern)
        ranked.append((-fixed.PERIOD_RANK[granularity], order, granularity, named))
    chosen = None
    for _, _, granularity, named in sorted(ranked, key=lambda r: r[:2]):
        hit = F.struct(
            F.lit(granularity).alias("granularity"), F.lit(fixed.PERIOD_CONFIDENCE[granularity]).alias("confidence")
        )
        chosen = F.when(named, hit) if chosen is None else chosen.when(named, hit)
    return chosen
