"""Ordered concatenation of files with banners.

The reference writes the files of one folder, sorted by name, into one file:
a two-line header, then per file a begin banner, the content, a blank line
and an end banner.  A folder can be arbitrarily large, so the combined text is
never built in one row.  Instead every file becomes one *segment* row; the
combined file is the segments of a group in (group, name) order, and
:func:`write_combined` writes them with a range-partitioned sort (a large
group spans several ordered part files, whose concatenation in part order is
the combined file).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Banner texts of the combined file.
HEADER = "# Combined Python File\n# This file is autogenerated by combine_python_files function\n\n"
BEGIN = "# ----- Begin {name} -----\n"
END = "# ----- End {name} -----\n\n"
# ---------------------------------------------------------------------------


def combine_files(files: DataFrame, group: str, name: str, text: str) -> DataFrame:
    """Segments (group, ord, name, segment); ord 0 is the header, files follow by name.

    Groups without files produce nothing, as the reference writes nothing.
    ``ord`` is the file name itself for file segments (W4: sorted by name) and
    the empty string for the header, so ordering by (group, ord) is the file.
    """
    begin_pre, begin_post = BEGIN.split("{name}")
    end_pre, end_post = END.split("{name}")
    seg = F.concat(F.lit(begin_pre), F.col(name), F.lit(begin_post), F.col(text), F.lit("\n\n"),
                   F.lit(end_pre), F.col(name), F.lit(end_post))
    body = files.select(F.col(group), F.lit(1).alias("part"), F.col(name).cast("string").alias("name"),
                        seg.alias("segment"))
    header = (files.select(group).distinct()
              .select(F.col(group), F.lit(0).alias("part"), F.lit("").alias("name"), F.lit(HEADER).alias("segment")))
    return header.unionByName(body)


def write_combined(segments: DataFrame, path: str, group: str) -> None:
    """Write each group's combined text under ``path/<group>=.../part-*`` in order.

    Every segment ends with a newline; the text writer adds one after each
    row, so the segment is written without its last character.
    """
    body = F.expr("substring(segment, 1, length(segment) - 1)")
    (segments.orderBy(group, "part", "name")
     .select(group, body.alias("segment"))
     .write.mode("overwrite").partitionBy(group).text(path))
