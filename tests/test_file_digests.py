import datetime
import hashlib
import io

from crosslane.sources import tables


def test_a_file_of_more_than_two_gigabytes(spark, tmp_path):
    """A sparse file of 2.5 GB: more than one value of Spark can hold."""
    (tmp_path / "in/a b").mkdir(parents=True)
    size = 5 << 29
    with open(tmp_path / "in/large.bin", "wb") as f:
        f.truncate(size)
    (tmp_path / "in/a b/small%20é.csv").write_bytes(b"x;y\n1;2\n")
    (tmp_path / "in/empty").write_bytes(b"")
    want, block = hashlib.sha256(), bytes(1 << 24)
    for _ in range(size >> 24):
        want.update(block)
    got = {r.name: (r.bytes, r.sha256) for r in tables.file_digests(spark, f"file://{tmp_path}/in").collect()}
    assert got.pop("large.bin") == (size, want.hexdigest())
    assert got == {"a b/small%20é.csv": (8, hashlib.sha256(b"x;y\n1;2\n").hexdigest())}
    manifest = spark.createDataFrame([("FR", datetime.date(2024, 1, 1), [("large.bin", want.hexdigest().upper(), size), ("empty", hashlib.sha256(b"").hexdigest(), 0), ("a b/small%20é.csv", "0", 8), ("gone", "0", 0)])], tables.MANIFEST)
    assert {(r.name, r.status) for r in tables.verify_files(spark, f"{tmp_path}/in", manifest).collect()} == {("large.bin", "ok"), ("empty", "ok"), ("a b/small%20é.csv", "mismatch"), ("gone", "missing")}


def test_an_opener_of_another_store(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/x").write_bytes(b"unread")
    got = tables.file_digests(spark, f"file://{tmp_path}/in", opener=lambda path: io.BytesIO(b"opened")).collect()
    assert [(r.name, r.bytes, r.sha256) for r in got] == [("x", 6, hashlib.sha256(b"opened").hexdigest())]
