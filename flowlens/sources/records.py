"""Tolerant records over a text column (S3, S4): quoted fields, lenient numbers, and a channel of rejects.

Native expressions only, so lines may come from any table or stream; nothing is staged in a file. A line is cut by
the CSV rules (quotes around a field may hold separators; doubled quotes stand for one).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.sources.readers import tolerant_double


def parse_records(lines: DataFrame, id_col: str, line_col: str, n_features: int, sep: str = ",", quote: str = '"') -> tuple[DataFrame, DataFrame]:
    """(records, rejects) of lines that hold ``n_features`` numbers and a label.

    Records: id, features (array of doubles), label (int), n_repaired. A field that is no number counts as 0.0, as
    does one that is missing at the end of a line; n_repaired says how many. Fields beyond the label are left out.
    Rejects: id, line, reason: ``blank`` (null, empty or white space) or ``one field`` (nothing to tell features
    and label apart by). Each line is in one of the two, so their counts add up. An empty table gives two empty ones.
    """
    names = [f"f{i}" for i in range(n_features + 1)]
    options = {"sep": sep, "quote": quote, "escape": quote, "mode": "PERMISSIVE", "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}
    line = F.col(line_col)
    blank = line.isNull() | (F.trim(line) == "")
    cut = lines.select(F.col(id_col), line, F.from_csv(line, ", ".join(f"{n} string" for n in names), options).alias("r"), blank.alias("blank"))
    single = F.col("r.f1").isNull() & ~F.contains(line, F.lit(sep))
    reason = F.when(F.col("blank"), "blank").when(single, "one field")
    tried = cut.withColumn("reason", reason)
    fields = [F.col(f"r.{n}") for n in names]
    repaired = sum(F.when(F.trim(f).try_cast("double").isNull(), 1).otherwise(0) for f in fields)
    records = tried.where("reason IS NULL").select(
        id_col,
        F.array(*[tolerant_double(f) for f in fields[:-1]]).alias("features"),
        tolerant_double(fields[-1]).cast("int").alias("label"),
        repaired.alias("n_repaired"),
    )
    return records, tried.where("reason IS NOT NULL").select(id_col, line_col, "reason")
