"""Sources and the combined-file writer: map-typed file stats (S2), S8 output."""

import os
import uuid

from pyspark.sql import functions as F

from issuelens.operators.combine import HEADER, combine_files, write_combined
from issuelens.session import ensure_checkpoint_dir
from issuelens.sources.tables import explode_file_stats


def _base(spark):
    return ensure_checkpoint_dir(spark).rstrip("/") + f"/src-test-{uuid.uuid4().hex}"


def test_explode_file_stats(spark):
    df = spark.createDataFrame(
        [("c1", {"a.py": (3, 1), "b.py": (0, 2)}), ("c2", {})],
        "sha string, files map<string, struct<insertions:int, deletions:int>>")
    got = sorted(tuple(r) for r in explode_file_stats(df).collect())
    assert got == [("c1", "a.py", 3, 1), ("c1", "b.py", 0, 2)]


def test_write_combined_is_ordered(spark):
    files = spark.createDataFrame([("g1", "b.py", "B"), ("g1", "a.py", "A"), ("g2", "z.py", "Z")],
                                  "grp string, name string, text string")
    out = _base(spark) + "/combined"
    write_combined(combine_files(files, "grp", "name", "text"), out, "grp")
    part_dir = f"{out}/grp=g1"
    text = "".join(open(os.path.join(part_dir, f)).read() for f in sorted(os.listdir(part_dir)) if f.startswith("part-"))
    assert text == (HEADER + "# ----- Begin a.py -----\nA\n\n# ----- End a.py -----\n\n"
                    + "# ----- Begin b.py -----\nB\n\n# ----- End b.py -----\n\n")
