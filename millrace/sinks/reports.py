"""Plain-text summary of a temperature run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import fixed_decimals
from millrace.operators.ranking import top_days

# The report's wording.
TITLE = "=== РЕЗУЛЬТАТЫ ОБРАБОТКИ ТЕМПЕРАТУРНЫХ ДАННЫХ ==="
ROWS_LINE = "Всего записей после очистки: %s"
LOW_LINE = "5-й процентиль: %s°C"
HIGH_LINE = "95-й процентиль: %s°C"
HOT_TITLE = "5 САМЫХ ЖАРКИХ ДНЕЙ:"
COLD_TITLE = "5 САМЫХ ХОЛОДНЫХ ДНЕЙ:"
DAY_LINE = "%s: %s°C"


def _day_lines(daily: DataFrame, hottest: bool, start: int, n: int) -> DataFrame:
    days = top_days(daily, n, hottest=hottest)
    value = F.col("temp").desc() if hottest else F.col("temp").asc()
    place = F.row_number().over(Window.orderBy(value, "noted_date"))
    text = F.format_string(
        DAY_LINE, F.date_format("noted_date", "yyyy-MM-dd"), fixed_decimals("temp", 2)
    )
    return days.select((place + F.lit(start)).alias("line_no"), text.alias("line"))


def _lines(source: DataFrame, numbered: list) -> DataFrame:
    lines = F.array(
        *[F.struct(F.lit(no).alias("line_no"), text.alias("line")) for no, text in numbered]
    )
    return source.select(F.inline(lines))


def summary_lines(stats: DataFrame, daily: DataFrame, n: int = 5) -> DataFrame:
    """Report lines with their number.

    ``stats`` is one row with ``rows_after``, ``lower_percentile`` and
    ``upper_percentile``; ``daily`` has ``noted_date`` and ``temp``.
    """
    def number(name):
        return fixed_decimals(name, 2)

    head = [
        (1, F.lit(TITLE)),
        (2, F.lit("")),
        (3, F.format_string(ROWS_LINE, F.col("rows_after").cast("string"))),
        (4, F.format_string(LOW_LINE, number("lower_percentile"))),
        (5, F.format_string(HIGH_LINE, number("upper_percentile"))),
        (6, F.lit("")),
        (7, F.lit(HOT_TITLE)),
        (8 + n, F.lit("")),
        (9 + n, F.lit(COLD_TITLE)),
    ]
    return (
        _lines(stats, head)
        .unionByName(_day_lines(daily, True, 7, n))
        .unionByName(_day_lines(daily, False, 9 + n, n))
    )


def write_text(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One text file, lines in order. A report is a few dozen lines."""
    lines.coalesce(1).sortWithinPartitions("line_no").select("line").write.mode(mode).text(path)
