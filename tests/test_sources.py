"""Records over many splits against Python's reader, and hashes of files against hashlib."""

import csv
import hashlib
import random
import subprocess
import sys

import pytest

from claimforge.sources.digest import file_hashes, fingerprint, streamed
from claimforge.sources.records import read_records, starts, text_lines

COLUMNS = ("a", "b", "c")


def write(path, rows, ending="\n", bom=True, blank=()):
    with open(path, "w", newline="", encoding="utf-8-sig" if bom else "utf-8") as f:
        writer = csv.writer(f, lineterminator=ending)
        writer.writerow(COLUMNS)
        for i, r in enumerate(rows):
            if i in blank:
                f.write(ending)
            writer.writerow(r)


def plain(path):
    with open(path, newline="", encoding="utf-8-sig") as f:
        return [(n, *(r[c] or None for c in COLUMNS)) for n, r in enumerate(csv.DictReader(f), 2)]


@pytest.fixture
def split(spark):
    """A session whose files are read in splits of about the given bytes."""
    def at(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        spark.conf.set("spark.sql.files.minPartitionNum", 50 if size < 10_000 else 1)

    yield at
    for key in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
        spark.conf.unset(f"spark.sql.files.{key}")


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_records_in_one_and_many_splits(spark, tmp_path, split, ending):
    rng = random.Random(3)
    cell = lambda: "".join(rng.choice(["x", " ", "é", ",", '"', ending, "日", "y" * 9]) for _ in range(rng.randrange(0, 12)))
    rows = [(i, cell(), cell() if i % 50 else ending.join(["a long value over many lines"] * 60)) for i in range(700)]
    path = str(tmp_path / "f.csv")
    write(path, rows, ending, blank=(0, 5, 6, 699))
    want = plain(path)
    assert len(want) == 700
    for size in (400, 5_000, 100_000_000):
        split(size)
        lines = text_lines(spark, path)
        n = len(starts(lines))
        assert n > 20 if size == 400 else n == 1 if size > 10**7 else n > 2
        got = sorted(tuple(r) for r in read_records(spark, path, COLUMNS, "n").collect())
        assert got == want


def test_short_records_and_headers(spark, tmp_path):
    path = str(tmp_path / "f.csv")
    (tmp_path / "f.csv").write_bytes(b'a,b,c\r\n1\r\n\r\n"2"," two ","x,\r\n3"\r\n')
    assert sorted(map(tuple, read_records(spark, path, COLUMNS, "n").collect())) == [(2, "1", None, None), (3, "2", " two ", "x,\r\n3")]
    with pytest.raises(ValueError, match="header"):
        read_records(spark, path, ("a", "b"), "n")
    with pytest.raises(ValueError, match="header"):
        read_records(spark, path, ("a", "b", "d"), "n")
    (tmp_path / "f.csv").write_bytes(b"a,b,c\n")
    assert read_records(spark, path, COLUMNS, "n").count() == 0
    (tmp_path / "f.csv").write_bytes(b"")
    with pytest.raises(ValueError, match="header"):
        read_records(spark, path, COLUMNS, "n")


def test_hashes_of_small_and_large_files(spark, tmp_path):
    rng = random.Random(1)
    (tmp_path / "in" / "json").mkdir(parents=True)
    content = {f"json/d {i}.json": rng.randbytes(rng.randrange(1, 3000)) for i in range(30)} | {"B.csv": rng.randbytes(500_000), "a.csv": b"x"}
    for name, data in content.items():
        (tmp_path / "in" / name).write_bytes(data)
    folder = str(tmp_path / "in")
    hashes = file_hashes(spark, [folder], whole=2000, recursiveFileLookup="true")
    got = {r.path.split("/in/")[1]: (r.length, r.sha256) for r in hashes.collect()}
    assert {k.replace("%20", " "): v for k, v in got.items()} == {n: (len(d), hashlib.sha256(d).hexdigest()) for n, d in content.items()}
    lines = b"".join(n.encode() + b"\0" + hashlib.sha256(content[n]).hexdigest().encode() + b"\n" for n in sorted(content))
    assert fingerprint(hashes, folder) == hashlib.sha256(lines).hexdigest()


def test_a_file_over_two_gigabytes_is_hashed_in_bounded_memory(tmp_path):
    path = tmp_path / "large.bin"
    with open(path, "wb") as f:
        f.truncate((2 << 30) + 5)  # a sparse file
        f.seek(-5, 2)
        f.write(b"xyz12")
    code = f"import resource; from claimforge.sources.digest import streamed; a = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss; h = streamed({str(path)!r}); print(h, resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - a)"
    h, grown = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, timeout=300).stdout.split()
    digest = hashlib.sha256()
    block = bytes(1 << 24)
    for _ in range(128):
        digest.update(block)
    digest.update(b"xyz12")
    assert h == digest.hexdigest() and int(grown) < 64 * 1024
    assert streamed(str(path), 1 << 16) == h
