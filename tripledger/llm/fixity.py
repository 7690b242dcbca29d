"""Fixity of WARC replicas by Merkle trees.

A leaf is the digest of one record. The records of a file lie in ordered offset ranges; ``FANOUT``
neighbours make a node whose digest covers their ranges and digests, and so on up to one root per file.
Replicas are compared from the roots down: only children of nodes that differ are looked at, so whole
files are known to be sound from their roots, and damage is found in as many steps as the tree has
levels. Replicas name the same files, so a lost or added record shifts its own file alone; below nodes
that differ, records are paired by their ids, not by their places. Everything is DataFrame work.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripledger.llm.tables import global_positions, open_folder, store, table, temporary_name

FANOUT = 16
# Records of one file.
FILE_RECORDS = 4096
# Fixed value: levels above the records of a full file, 16^3 = 4096.
LEVELS = 3
# What a record is known by, whatever its content.
IDENTITY = ["page_id", "url_crc32"]


# The parts of a record's header around its values, and its end.
HEAD = (
    "WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: ",
    "\r\nWARC-Date: 2024-01-01T00:00:00Z\r\nWARC-Record-ID: <urn:page:",
    ">\r\nContent-Type: text/html\r\nContent-Length: ",
    "\r\n\r\n",
)
END = "\r\n\r\n"


def record_bytes(url: Column, payload: Column, record_id: Column) -> Column:
    """A WARC/1.1 resource record as bytes; null is empty."""
    body = F.coalesce(payload, F.lit("")).cast("binary")
    values = (F.coalesce(url, F.lit("")), F.coalesce(record_id.cast("string"), F.lit("none")), F.length(body).cast("string"))
    head = F.concat(*[part for pair in zip(map(F.lit, HEAD), (*values, F.lit("")), strict=True) for part in pair])
    return F.concat(head.cast("binary"), body, F.lit(END).cast("binary"))


def leaves(records: DataFrame) -> DataFrame:
    """(file, seq, start, end, digest and the other columns) of records with ``file``, ``place`` in it and ``length``.

    ``seq`` counts the records a replica has in a file, ``start`` and ``end`` are their offsets there. The
    windows hold one file.
    """
    in_file = Window.partitionBy("file").orderBy("place", *IDENTITY, "digest")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    placed = records.withColumns(
        {"seq": F.row_number().over(in_file) - 1, "start": F.coalesce(F.sum("length").over(before), F.lit(0))}
    )
    return placed.withColumn("end", F.col("start") + F.col("length")).drop("place", "length")


def parents(nodes: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """(file, seq, start, end, digest) one level up: a digest over the ranges and digests of the children in order."""
    child = F.struct("seq", "start", "end", "digest")
    grouped = nodes.groupBy("file", F.expr(f"seq div {fanout}").cast("int").alias("seq")).agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.sort_array(F.collect_list(child)).alias("_children")
    )
    line = F.transform("_children", lambda c: F.concat_ws(" ", c["seq"].cast("string"), c["start"].cast("string"), c["end"].cast("string"), c["digest"]))
    return grouped.withColumn("digest", F.sha2(F.concat_ws("\n", line), 256)).drop("_children")


def tree(records: DataFrame, levels: int = LEVELS, fanout: int = FANOUT) -> list[DataFrame]:
    """The levels of the trees of all files, records first, each stored in the shared folder."""
    found = [store(records, "merkle-0")]
    for level in range(1, levels + 1):
        found.append(store(parents(found[-1].select("file", "seq", "start", "end", "digest"), fanout), f"merkle-{level}"))
    return found


def audit(ours: list[DataFrame], theirs: list[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """(file, seq, ours_start, ours_end, theirs_start, theirs_end, kind, page_id) of every record in which the replicas differ.

    ``kind``: ``changed`` content, ``moved`` to another range with the same content, ``missing`` in theirs or
    ``extra`` there; file and seq are ours, theirs for an extra record. Levels are compared from the roots
    down, and below a node only if it differs. Records are paired by their identity, wherever they lie.
    """
    suspects = None
    for level in range(len(ours) - 1, -1, -1):
        more = () if level else IDENTITY
        a, b = (_side(side[level], name, more) for side, name in ((ours, "ours"), (theirs, "theirs")))
        if suspects is not None:
            parent = F.expr(f"seq div {fanout}").cast("int")
            a, b = (x.withColumn("_up", parent).join(suspects, ["file", "_up"], "left_semi").drop("_up") for x in (a, b))
        differing = a.join(b, ["file", "seq"], "full").where(~F.col("ours").eqNullSafe(F.col("theirs")))
        if level:
            suspects = store(differing.select("file", F.col("seq").alias("_up")), "suspects")
    differing = store(differing, "differing")
    a, b = (differing.where(F.col(name).isNotNull()).select("file", "seq", f"{name}.*") for name in ("ours", "theirs"))
    # Equal records first, then what is left of each id, both in their order.
    equal = _paired(a, b, [*IDENTITY, "digest"])
    rest = [equal.where(f"{other} is null").select(f"{own}.*") for own, other in (("ours", "theirs"), ("theirs", "ours"))]
    whole = equal.where("ours is not null and theirs is not null").withColumn("kind", F.lit("moved"))
    place = [F.struct(*[f"{side}.{name}" for name in ("file", "start", "end")]) for side in ("ours", "theirs")]
    kind = F.when(F.col("theirs").isNull(), "missing").when(F.col("ours").isNull(), "extra").otherwise("changed")
    pairs = whole.where(place[0] != place[1]).unionByName(_paired(*rest, IDENTITY).withColumn("kind", kind))
    at = [F.coalesce(f"ours.{name}", f"theirs.{name}").alias(name) for name in ("file", "seq")]
    ends = [F.col(f"{side}.{end}").alias(f"{side}_{end}") for side in ("ours", "theirs") for end in ("start", "end")]
    return pairs.select(*at, *ends, "kind", F.coalesce("ours.page_id", "theirs.page_id").alias("page_id"))


def _paired(ours: DataFrame, theirs: DataFrame, keys: list[str]) -> DataFrame:
    """(ours, theirs): records as structs; the n-th with some keys here and the n-th there, null where there is none."""
    sides = []
    for side, name in ((ours, "ours"), (theirs, "theirs")):
        # Numbers within a key are differences of places, so that a key with very many records needs no window.
        placed = store(global_positions(side, [*keys, "file", "seq"], "_place"), f"paired-{name}")
        key = F.to_json(F.struct(*keys))
        firsts = placed.groupBy(key.alias("_key")).agg(F.min("_place").alias("_first"))
        numbered = placed.withColumn("_key", key).join(firsts, "_key").withColumn("_n", F.col("_place") - F.col("_first"))
        sides.append(numbered.select("_key", "_n", F.struct(*side.columns).alias(name)))
    return store(sides[0].join(sides[1], ["_key", "_n"], "full").select("ours", "theirs"), "pairs")


def _side(nodes: DataFrame, name: str, more: Sequence[str] = ()) -> DataFrame:
    return nodes.select("file", "seq", F.struct("start", "end", "digest", *more).alias(name))


def records(pages: DataFrame, file_records: int = FILE_RECORDS, **payloads: Column) -> DataFrame:
    """(page_id, url_crc32, file, place) of all pages in page_id order, null ids first, and what each payload gives.

    A payload's column is a struct of the digest and the length of the record. The first payload is the
    one that was filed: its order says which file, of so many records, a page lies in.
    """
    contents = {name: record_bytes(F.col("url"), payload, F.col("page_id")) for name, payload in payloads.items()}
    first = next(iter(payloads))
    narrow = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.crc32(F.coalesce("url", F.lit("")).cast("binary")).alias("url_crc32"),
        *[F.struct(F.sha2(c, 256).alias("digest"), F.length(c).cast("long").alias("length")).alias(n) for n, c in contents.items()],
    )
    placed = global_positions(narrow, [*IDENTITY, f"{first}.length", f"{first}.digest"], "place")
    return placed.withColumn("file", F.expr(f"place div {file_records}"))


def holding(filed: DataFrame, name: str) -> DataFrame:
    """Leaves of the replica that holds the named payload in the files of :func:`records`."""
    return leaves(filed.select(*IDENTITY, "file", "place", f"{name}.digest", f"{name}.length"))


def replica(pages: DataFrame, payload: Column) -> DataFrame:
    """Leaves of the WARC files of all pages in page_id order, null ids first, filed by themselves."""
    return holding(records(pages, html=payload), "html")


def write_replica(filed: DataFrame, folder: str) -> DataFrame:
    """Writes the records (file, place, bytes) to one WARC file per ``file`` below the folder; returns the manifest (file, name).

    Records follow each other in order of ``place``. A file appears when it is complete; a task that runs
    again writes the same file. Files have as many records as :func:`records` gives them, or a few more.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, path = open_folder(folder)
        current, out, draft = None, None, ""

        def close() -> pa.RecordBatch:
            out.close()
            filesystem.move(draft, f"{path}/{current:08d}.warc")
            return pa.RecordBatch.from_pydict({"file": pa.array([current], pa.int64()), "name": [f"{current:08d}.warc"]})

        for batch in batches:
            for file, data in zip(batch.column("file").to_pylist(), batch.column("bytes"), strict=True):
                if file != current:
                    if out:
                        yield close()
                    current, draft = file, f"{path}/{temporary_name(f'{file:08d}')}"
                    out = filesystem.open_output_stream(draft)
                out.write(data.as_py())
        if out:
            yield close()

    ordered = filed.select(F.col("file").cast("long").alias("file"), "place", "bytes").repartition("file").sortWithinPartitions("file", "place", "bytes")
    manifest = f"{folder}/manifest"
    ordered.select("file", "bytes").mapInArrow(write, "file long, name string").write.parquet(manifest)
    return filed.sparkSession.read.parquet(manifest)


def parsed(data: bytes) -> Iterator[tuple[int, int, int | None, bytes]]:
    """(start, end, page_id, uri) of the records in a file's bytes, whatever has happened to them.

    Where a record doesn't end as its length says, it ends where the next one begins, or the file ends.
    """
    magic, stop, start = HEAD[0][:10].encode(), END.encode(), 0
    while start < len(data):
        head_end = data.find(stop, start)
        head = data[start : head_end if head_end >= 0 else len(data)]
        length = re.search(rb"Content-Length: ([0-9]{1,18})", head)
        end = head_end + len(stop) + int(length[1]) + len(stop) if length and head_end >= 0 else -1
        if end < 0 or data[end - len(stop) : end] != stop or end < len(data) and not data.startswith(magic, end):
            following = data.find(stop + magic, start + 1)
            end = following + len(stop) if following >= 0 else len(data)
        name, uri = re.search(rb"<urn:page:(-?[0-9]{1,18})>", head), re.search(rb"WARC-Target-URI: ([^\r\n]*)", head)
        yield start, end, int(name[1]) if name else None, uri[1] if uri else b""
        start = end


def read_replica(manifest: DataFrame, folder: str) -> DataFrame:
    """Leaves of the WARC files that the manifest (file, name) lists: what :func:`tree` takes.

    A file that is gone has no records, so that all of its records are missing.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, path = open_folder(folder)
        for batch in batches:
            for file, name in zip(batch.column("file").to_pylist(), batch.column("name").to_pylist(), strict=True):
                try:
                    with filesystem.open_input_stream(f"{path}/{name}") as stream:
                        data = stream.read()
                except FileNotFoundError:
                    continue
                found = [
                    (file, seq, start, end, hashlib.sha256(data[start:end]).hexdigest(), page_id, zlib.crc32(uri))
                    for seq, (start, end, page_id, uri) in enumerate(parsed(data))
                ]
                columns = list(zip(*found, strict=True)) if found else [[]] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(columns, kinds, strict=True)], [n for n, _ in kinds])

    kinds = [
        ("file", pa.int64()), ("seq", pa.int32()), ("start", pa.int64()), ("end", pa.int64()),
        ("digest", pa.string()), ("page_id", pa.int64()), ("url_crc32", pa.int64()),
    ]
    files = manifest.select(F.col("file").cast("long").alias("file"), "name")
    dealt = files.repartition(max(1, manifest.sparkSession.sparkContext.defaultParallelism * 2), "file")
    return dealt.mapInArrow(read, "file long, seq int, start long, end long, digest string, page_id long, url_crc32 long")


def audit_stored(ours: tuple[DataFrame, str], theirs: tuple[DataFrame, str], levels: int = LEVELS, fanout: int = FANOUT) -> DataFrame:
    """:func:`audit` of two stored replicas, each a manifest and a folder, from the bytes of their files."""
    return audit(*(tree(read_replica(*side), levels, fanout) for side in (ours, theirs)), fanout)


def rotten(page_id: Column, html: Column) -> Column:
    """The payload with a sign in place of its first or its last character, for about one page in fifty."""
    fate, mark = F.pmod(page_id * 7919, F.lit(97)), F.lit("#")
    longer = F.length(html) > 0
    return (
        F.when((fate == 0) & longer, F.concat(mark, F.substring(html, F.lit(2), F.length(html))))
        .when((fate == 1) & longer, F.concat(F.substring(html, F.lit(1), F.length(html) - 1), mark))
        .otherwise(html)
    )


ORACLE = {
    "op9_merkle_fixity": """
        WITH p AS (
            SELECT page_id, html, strlen(coalesce(html, '')) AS body,
                   strlen(coalesce(url, '')) + length(coalesce(cast(page_id AS varchar), 'none')) AS head,
                   row_number() OVER (ORDER BY page_id NULLS FIRST) - 1 AS position
            FROM pages
        ), r AS (
            SELECT *, position // 4096 AS file, cast(position % 4096 AS int) AS seq,
                   head + FIXED + length(cast(body AS varchar)) + body AS size
            FROM p
        ), o AS (
            SELECT *, cast(sum(size) OVER (PARTITION BY file ORDER BY seq) AS bigint) AS stop FROM r
        )
        SELECT file, seq, stop - size AS ours_start, stop AS ours_end, stop - size AS theirs_start, stop AS theirs_end,
               'changed' AS kind, page_id
        FROM o
        WHERE (page_id * 7919) % 97 = 0 AND left(html, 1) <> '#' OR (page_id * 7919) % 97 = 1 AND right(html, 1) <> '#'
    """.replace("FIXED", str(len("".join(HEAD) + END)))
}


def op9_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records in two replicas, one of them damaged; the audit must find every damaged record."""
    html = F.col("html")
    filed = records(table(spark, sf_dir, "pages"), sound=html, damaged=rotten(F.col("page_id"), html))
    return audit(*(tree(holding(filed, name)) for name in ("sound", "damaged")))
