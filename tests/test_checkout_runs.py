"""Checkout source (S4) against a listing, and appends that can be retried."""

import hashlib
import os
import random

import pytest

from issuelens.session import ensure_checkpoint_dir
from issuelens.sources import checkout as CK
from issuelens.sources.sinks import append_run, read_dataset, runs, write_dataset


def made(top):
    """Folders with hidden and odd names, binary files, links, an empty folder, a large one, and .git folders."""
    rnd = random.Random(4)
    files = {"_private.py": b"x = 1\n", ".hidden/deep/_a.js": b"//\n", "a-b/c.py": b"1", "a/c.py": b"1", "a/b/d.py": b"", "ü/é ö.py": "ñ".encode(),
             "bin/x.py": b"\xff\x00", "sub/.git/config.py": b"kept", "README": b"no suffix"}
    files |= {f"many/{i:03}.py": bytes(rnd.choices(b"abc\n", k=20)) for i in range(230)}
    for path, content in files.items():
        os.makedirs(os.path.dirname(os.path.join(top, path)), exist_ok=True)
        with open(os.path.join(top, path), "wb") as f:
            f.write(content)
    os.makedirs(os.path.join(top, "empty/er"))
    os.makedirs(os.path.join(top, ".git/objects"))
    with open(os.path.join(top, ".git/objects/x.py"), "w") as f:
        f.write("no part of the tree")
    os.symlink("../a", os.path.join(top, "a/loop"))
    os.symlink("c.py", os.path.join(top, "a/link.py"))
    return files | {"a/loop": b"../a", "a/link.py": b"c.py"}


def test_a_folder_is_its_listing(spark, tmp_path):
    files = made(str(tmp_path / "top"))
    df = CK.read_checkout(spark, f"file://{tmp_path}/top", files="50")
    assert df.rdd.getNumPartitions() >= 5  # the large folder alone is five slices
    got = {r.path: (r.blob_sha, r.n_bytes, r.text) for r in df.collect()}
    sha = lambda b: hashlib.sha1(b"blob %d\0" % len(b) + b).hexdigest()
    assert got == {p: (sha(b), len(b), b.decode()) for p, b in files.items() if p != "bin/x.py"}
    kept = {r.path: r.text for r in CK.read_checkout(spark, str(tmp_path / "top"), (".py",), binary="true").collect()}
    assert kept.keys() == {p for p in files if p.endswith(".py")} and kept["bin/x.py"] is None


def test_tables_of_a_checkout(spark, tmp_path):
    files = made(str(tmp_path / "top"))
    entries, blobs = CK.scan_checkout(spark, str(tmp_path / "top"), "head", (".py",))
    want = sorted((p for p in files if p.endswith(".py") and p != "bin/x.py"), key=lambda p: (p.count("/"), p.encode()))
    rows = entries.orderBy("seq").collect()
    assert [(r.snapshot_sha, r.path, r.seq, r.entry_type) for r in rows] == [("head", p, k, "blob") for k, p in enumerate(want, 1)]
    content = {r.blob_sha: bytes(r.content) for r in blobs.collect()}
    assert {r.path: content[r.blob_sha] for r in rows} == {p: files[p] for p in want}
    assert blobs.count() == len({files[p] for p in want})


def test_files_are_written_and_read_back(spark, tmp_path):
    rows = [("a/b.py", "x\n"), ("_c", ""), ("a/.d/ü", None)]
    CK.write_checkout(spark.createDataFrame(rows, "path string, text string"), str(tmp_path / "out"))
    assert {(r.path, r.text) for r in CK.read_checkout(spark, str(tmp_path / "out")).collect()} == {(p, t or "") for p, t in rows}
    with pytest.raises(Exception, match="leads out"):
        CK.write_checkout(spark.createDataFrame([("../x", "y")], "path string, text string"), str(tmp_path / "out"))
    assert CK.read_checkout(spark, str(tmp_path / "out")).count() == 3
    with pytest.raises(ValueError, match="mount"):
        CK.local_folder("hdfs://host/x")


def test_a_run_is_appended_once(spark):
    out = ensure_checkpoint_dir(spark).rstrip("/") + "/runs-test"
    df = spark.createDataFrame([(1, None), (2, "x")], "id bigint, t string")
    assert runs(spark, out) == []
    assert append_run(df, out, "monday") is True
    assert append_run(df, out, "monday") is False
    assert read_dataset(spark, out).count() == 2
    assert append_run(df, out, "tuesday") is True
    assert read_dataset(spark, out, df.schema).count() == 4 and runs(spark, out) == ["monday", "tuesday"]
    write_dataset(df, out)  # a plain append beside them
    assert read_dataset(spark, out).count() == 6
    for bad in ("", "a/b", "../x", "_x"):
        with pytest.raises(ValueError, match="run id"):
            append_run(df, out, bad)


def test_what_a_failed_run_left_is_replaced(spark):
    out = ensure_checkpoint_dir(spark).rstrip("/") + "/runs-failed"
    df = spark.createDataFrame([(1,), (2,)], "id bigint")
    write_dataset(df.limit(1), f"{out}/_draft-a")  # written, never committed
    assert append_run(df, out, "b") and read_dataset(spark, out).count() == 2 and runs(spark, out) == ["b"]
    assert append_run(df, out, "a") and read_dataset(spark, out).count() == 4
