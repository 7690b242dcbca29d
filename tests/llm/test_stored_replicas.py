"""Replicas as WARC files: written, damaged byte by byte, read back and audited."""

from __future__ import annotations

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tripledger.llm.fixity import audit_stored, parsed, read_replica, record_bytes, write_replica
from tripledger.llm.tables import scratch_path

FILE = 20


@pytest.fixture(scope="module")
def filed(spark):
    draw = random.Random(1)
    rows = [(i if i != 7 else None, f"http://x/{i}", "é<p>\r\n" * draw.randint(0, 40) if i % 11 else None, i // FILE, i) for i in range(90)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, file long, place long")
    return pages.withColumn("bytes", record_bytes(F.col("url"), F.col("html"), F.col("page_id")))


def replica(spark, filed):
    folder = scratch_path(spark, "replica")
    return write_replica(filed, folder), folder


def kinds(ours, theirs):
    rows = audit_stored(ours, theirs, levels=2, fanout=5).collect()
    return sorted((r["file"], r["kind"], -1 if r["page_id"] is None else r["page_id"]) for r in rows)


def path(folder, file):
    return Path(folder.removeprefix("file:")) / f"{file:08d}.warc"


def test_read_back(spark, filed):
    manifest, folder = replica(spark, filed)
    assert sorted((r["file"], r["name"]) for r in manifest.collect()) == [(i, f"{i:08d}.warc") for i in range(5)]
    found = sorted(map(tuple, read_replica(manifest, folder).select("file", "seq", "start", "end", "page_id").collect()))
    at, expected = {}, []
    for row in filed.orderBy("place").collect():
        start = at.get(row["file"], 0)
        at[row["file"]] = start + len(row["bytes"])
        expected.append((row["file"], row["place"] % FILE, start, at[row["file"]], row["page_id"]))
    assert found == expected
    assert kinds((manifest, folder), replica(spark, filed)) == []


def test_damage_to_bytes_is_located(spark, filed):
    ours, (manifest, folder) = replica(spark, filed), replica(spark, filed)
    rows = {r["place"]: bytes(r["bytes"]) for r in filed.collect()}
    place = lambda k: sum(len(rows[i]) for i in range(k // FILE * FILE, k))

    def change(file, edit):
        target = path(folder, file)
        target.write_bytes(edit(target.read_bytes()))

    # A flipped byte in the payload, one in a length, a record cut out, one put in, one made longer; a file lost.
    change(0, lambda d: d[: (end := place(6)) - 5] + bytes([d[end - 5] ^ 1]) + d[end - 4 :])
    broken = place(24) + rows[24].index(b"Content-Length: ") + 16
    change(1, lambda d: d[:broken] + b"x" + d[broken + 1 :])
    change(2, lambda d: d[: place(57)] + d[place(58) :])
    longer = rows[79][:-4] + b"++" + rows[79][-4:]
    change(3, lambda d: d[: place(79)] + longer)
    path(folder, 4).unlink()
    found = kinds(ours, (manifest, folder))
    assert found == sorted(
        [(0, "changed", 5), (1, "changed", 24), (2, "missing", 57), (2, "moved", 58), (2, "moved", 59), (3, "changed", 79)]
        + [(4, "missing", i) for i in range(80, 90)]
    )


def test_added_records(spark, filed):
    extra = filed.where("place = 45").withColumn("page_id", F.lit(-46).cast("long"))
    extra = extra.withColumn("bytes", record_bytes(F.col("url"), F.col("html"), F.col("page_id"))).withColumn("place", F.lit(58).cast("long"))
    more = filed.unionByName(extra)
    found = kinds(replica(spark, filed), replica(spark, more))
    assert (2, "extra", -46) in found and {k for _, k, _ in found} == {"extra", "moved"}


def test_bytes_that_are_no_records():
    assert list(parsed(b"")) == [] and list(parsed(b"junk")) == [(0, 4, None, b"")]
    assert list(parsed(b"WARC/1.1\r\nContent-Length: 99\r\n\r\nab")) == [(0, 34, None, b"")]


def test_no_records(spark, filed):
    empty = replica(spark, filed.limit(0))
    assert kinds(empty, empty) == []
