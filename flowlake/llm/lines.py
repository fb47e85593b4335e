"""Line dedup: fuzzy lines by MinHash, one line kept per component.

1. Lines are hashed; equal lines are one class, reduced in each task before the shuffle.
2. Every distinct line of a batch gets a one-permutation MinHash signature of its character
   shingles and ``BANDS`` band keys. Keys go to the owners of the key ranges in packed arrays, and
   only keys that different lines share come back.
3. Lines that share a key are candidates. Each line is compared, by exact Jaccard (80 %) of the shingle
   sets, with one star of each of its keys, and a key whose lines are linked by then is done.
4. Of the other keys, each one's lines are compared with each other in one task, a line with all lines
   at once, leaving out what is linked already; a task gives no more links than join its components.
   Lines of a key with more lines than a task should hold meet by their rarest shingles instead, one
   more of them than a similar line can lack, so that no similar two miss each other; a shingle that
   is still too wide is cut into parts, compared two by two.
5. Distributed union-find gives components; of each, the line that comes first by (doc_id, line
   number) stays.

Lines are cut at line feeds. Blank lines always stay. A line shorter than a shingle is its own only
shingle. At the threshold itself a pair is found with a probability above 0.998, and almost surely
above it. NULL text counts as one empty line. Rows of one doc_id and text are one document; other
texts of that doc_id are documents of their own, ordered by line number and a hash of the text. A NULL
doc_id comes after all others, so the lines of its rows go first. An empty table gives no rows; other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from flowlake.llm.common import mix64, parts_of, power_of_two, prefix_sums, written
from flowlake.llm.components import components

SHINGLE = 8
BANDS, BAND_ROWS = 12, 4
BINS = BANDS * BAND_ROWS
OWNER_KEYS = 1_000_000
SLICE_CHARS = 1 << 19
PERCENT = 80
# What a task compares at once: lines of one key, and shingles of them.
PART_LINES = 4_096
PART_SHINGLES = 1 << 20
_EMPTY = np.uint32(0xFFFFFFFF)

_MESSAGE = "owner long, keys binary, lines binary"


def shingle_hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all lines' shingles, the line each belongs to). No line is empty."""
    chars = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), "<u4")
    length = np.fromiter(map(len, lines), np.int64, len(lines))
    end = np.cumsum(length)
    total, down = prefix_sums(chars)
    # Windows of all places, then those that begin a shingle within its line.
    hashes = np.zeros(len(chars), np.uint64)
    whole = max(0, len(chars) - SHINGLE + 1)
    np.subtract(total[SHINGLE:], total[:whole], out=hashes[:whole])
    hashes *= down[: len(chars)]
    hashes += np.uint64(SHINGLE)
    short = np.flatnonzero(length < SHINGLE)
    begin = (end - length)[short]
    with np.errstate(over="ignore"):
        hashes[begin] = (total[end[short]] - total[begin]) * down[begin] + length[short].astype(np.uint64)
    starts = np.ones(len(chars), bool)
    for k in range(1, SHINGLE):
        starts[(end - k)[length > k]] = False
    return mix64(hashes[starts]), np.repeat(np.arange(len(lines)), np.maximum(length - SHINGLE + 1, 1))


def band_keys(lines: list[str]) -> np.ndarray:
    """(lines x BANDS) keys; similar lines agree in some."""
    hashes, line = shingle_hashes(lines)
    place = line * BINS + ((hashes >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
    least = np.full(len(lines) * BINS, _EMPTY, np.uint32)
    np.minimum.at(least, place, np.minimum(hashes.astype(np.uint32), _EMPTY - np.uint32(1)))
    least = least.reshape(-1, BINS)
    rows = np.flatnonzero((least == _EMPTY).any(axis=1))
    part = least[rows]
    # An empty bin takes the next full one's value, changed by the distance.
    for _ in range(BINS):
        gap = part == _EMPTY
        if not gap.any():
            break
        nxt = np.roll(part, -1, axis=1)
        part = np.where(gap & (nxt != _EMPTY), (nxt * np.uint32(0x9E3779B1) + np.uint32(1)) & np.uint32(0xFFFFFFFE), part)
    least[rows] = part
    keys = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[None, :], len(lines), axis=0)
    values = least.reshape(-1, BANDS, BAND_ROWS).astype(np.uint64)
    with np.errstate(over="ignore"):
        for i in range(BAND_ROWS):
            keys = mix64(keys * np.uint64(0xD6E8FEB86659FD93) + values[:, :, i])
    return keys


def _document(docs: DataFrame) -> list[Column]:
    """What names a document: its doc_id and a hash of its text."""
    return [docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("t")]


def _place() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "line_no", "t")


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, t, line_no, line, h, g): all lines that are not blank, with a hash of their text and
    two 64-bit hashes of their own."""
    text = F.coalesce(docs["text"], F.lit(""))
    return (
        docs.select(*_document(docs), F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
        .filter(F.trim("line") != "")
        .select("doc_id", "t", "line_no", "line", F.xxhash64("line").alias("h"), F.xxhash64(F.lit(1), "line").alias("g"))
    )


def _sender(owner_bits: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("owner", pa.int64()), ("keys", pa.binary()), ("lines", pa.binary())])

        def packed(names: list, texts: list):
            keys = band_keys(texts).ravel()
            lines = np.repeat(np.array(names, np.int64), BANDS)
            order = np.argsort(keys)
            keys, lines = keys[order], lines[order]
            owners = (keys >> np.uint64(64 - owner_bits)).astype(np.int64)
            found, begin = np.unique(owners, return_index=True)
            rows = [
                (o, keys[a:b].tobytes(), lines[a:b].tobytes())
                for o, a, b in zip(found.tolist(), begin, [*begin[1:], len(keys)])
            ]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for batch in batches:
            seen, names, texts, size = set(), [], [], 0
            for name, line in zip(batch.column(0).to_pylist(), batch.column(1)):
                if name in seen:
                    continue
                seen.add(name)
                names.append(name)
                texts.append(line.as_py())
                size += len(texts[-1])
                if size >= SLICE_CHARS:
                    yield packed(names, texts)
                    names, texts, size = [], [], 0
            if names:
                yield packed(names, texts)

    return send


def _shared(table: pa.Table) -> pa.Table:
    """(key, h) of the keys that different lines share."""
    keys = np.concatenate([np.frombuffer(k, np.int64) for k in table["keys"].to_pylist()])
    lines = np.concatenate([np.frombuffer(k, np.int64) for k in table["lines"].to_pylist()])
    order = np.lexsort((lines, keys))
    keys, lines = keys[order], lines[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (lines[1:] != lines[:-1])
    keys, lines = keys[new], lines[new]
    same = keys[1:] == keys[:-1]
    more = np.zeros(len(keys), bool)
    more[1:] |= same
    more[:-1] |= same
    return pa.table({"key": keys[more], "h": lines[more]})


def shingle_sets(lines: list[str]) -> list[np.ndarray]:
    """Distinct shingle hashes of each line, ascending."""
    hashes, owner = shingle_hashes(lines)
    sets = np.split(hashes, np.searchsorted(owner, np.arange(1, len(lines))))
    for i, own in enumerate(sets):
        own.sort()
        new = own[1:] != own[:-1]
        if not new.all():
            sets[i] = own[np.concatenate(([True], new))]
    return sets


def _sized(texts: DataFrame) -> DataFrame:
    """The lines with the sizes of their shingle sets."""

    def size(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [len(s) for part in _slices(batch.column("line").to_pylist()) for s in shingle_sets(part)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes, pa.int64())], names=["h", "g", "line", "n"])

    return texts.mapInArrow(size, "h long, g long, line string, n long")


def _slices(lines: list[str]) -> Iterator[list[str]]:
    """The lines in order, in lists of about ``SLICE_CHARS``."""
    held, size = [], 0
    for line in lines:
        held.append(line)
        size += len(line)
        if size >= SLICE_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _near(na: str, nb: str) -> Column:
    return (F.col(na) * 100 >= F.col(nb) * PERCENT) & (F.col(nb) * 100 >= F.col(na) * PERCENT)


def _stars(keys: DataFrame) -> DataFrame:
    """(a, b): each line of (key, cid, n, crowd) beside that line of its key that has the most crowded
    keys, which is near the middle of a group of near copies."""
    star = F.max(F.struct("crowd", "cid", "n"))
    stars = keys.groupBy("key").agg(star.alias("star")).select("key", F.col("star.cid").alias("s"), F.col("star.n").alias("ns"))
    return (
        keys.join(stars, "key").filter((F.col("s") != F.col("cid")) & _near("n", "ns"))
        .select(F.least("s", "cid").alias("a"), F.greatest("s", "cid").alias("b")).distinct()
    )


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of lines whose shingle sets are similar."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

        def similar(held: list, lines: dict):
            sets = dict(zip(lines, shingle_sets(list(lines.values()))))
            found = []
            for a, b in held:
                x, y = sets[a], sets[b]
                both = len(np.intersect1d(x, y, assume_unique=True))
                if both * 100 >= PERCENT * (len(x) + len(y) - both):
                    found.append((a, b))
            left, right = zip(*found) if found else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], schema=schema)

        for batch in batches:
            held, lines, size = [], {}, 0
            for a, ta, b, tb in zip(*(batch.column(c) for c in ("a", "ta", "b", "tb"))):
                a, b = a.as_py(), b.as_py()
                for name, line in ((a, ta), (b, tb)):
                    if name not in lines:
                        lines[name] = line.as_py()
                        size += len(lines[name])
                held.append((a, b))
                if size >= SLICE_CHARS:
                    yield similar(held, lines)
                    held, lines, size = [], {}, 0
            if held:
                yield similar(held, lines)

    left = texts.select(F.col("cid").alias("a"), F.col("line").alias("ta"))
    right = texts.select(F.col("cid").alias("b"), F.col("line").alias("tb"))
    return pairs.join(right, "b").join(left, "a").select("a", "ta", "b", "tb").mapInArrow(check, "a long, b long")


def _open(rows: DataFrame, least: int) -> DataFrame:
    """(key, parts): the keys of (key, cid, n, root) with ``least`` or more lines, not all of one component,
    one key of those with the same lines, and how many parts each is cut into."""
    sums = rows.groupBy("key").agg(
        F.count("*").alias("c"), F.sum("n").alias("m"), F.bit_xor(F.xxhash64("cid")).alias("x"),
        F.bit_xor(F.xxhash64(F.lit(1), "cid")).alias("y"), F.min("root").alias("r"), F.max("root").alias("s"),
    )
    one = sums.filter((F.col("c") >= least) & (F.col("r") != F.col("s"))).groupBy("c", "m", "x", "y").agg(F.min("key").alias("key"))
    parts = F.ceil(F.greatest(F.col("c") / PART_LINES, F.col("m") / PART_SHINGLES))
    return one.select("key", F.when(F.col("c") > 2, parts).otherwise(F.lit(1)).cast("long").alias("parts"))


def _spread(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, cid, n, root, i, j): the lines of a key by pairs of its parts, so that any two of them
    meet; a key of one part is as it is."""
    part = F.pmod(F.xxhash64("cid"), "parts")
    met = rows.join(keys, "key").withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return met.select("key", "cid", "n", "root", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"))


def _group_links(roots: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links (x, y) between lines of different roots, as many as join all similar ones of them."""
    size = np.array([len(s) for s in sets])
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    begin = np.cumsum(size) - size
    flags = np.zeros(flat.max() + 1, bool)
    _, comp, count = np.unique(roots, return_inverse=True, return_counts=True)
    out = []
    # Any pair of different components has a line outside of the largest.
    for x in np.flatnonzero(comp != count.argmax()):
        mine = flat[begin[x] : begin[x] + size[x]]
        flags[mine] = True
        both = np.add.reduceat(flags[flat], begin, dtype=np.int64)
        flags[mine] = False
        linked = (both * 100 >= PERCENT * (size[x] + size - both)) & (comp != comp[x])
        for y in np.flatnonzero(linked):
            if comp[y] != comp[x]:
                out.append((int(x), int(y)))
                comp[comp == comp[y]] = comp[x]
    return out


def _rarest(lines: DataFrame) -> DataFrame:
    """(key, cid): the rarest shingles of each of (cid, line), one more than a similar line can lack, but
    those that no other line has. Two similar lines have one of them in common."""

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cids, at = batch.column("cid").to_numpy(), 0
            for part in _slices(batch.column("line").to_pylist()):
                sets = shingle_sets(part)
                owners = np.repeat(cids[at : at + len(part)], [len(s) for s in sets])
                yield pa.RecordBatch.from_arrays([pa.array(owners), pa.array(np.concatenate(sets).view(np.int64))], names=["cid", "s"])
                at += len(part)

    each = lines.select("cid", "line").mapInArrow(shingles, "cid long, s long")
    counts = each.groupBy("s").agg(F.count("*").alias("c"))
    ordered = each.join(counts, "s").groupBy("cid").agg(F.array_sort(F.collect_list(F.struct("c", "s"))).alias("all"))
    shared = F.ceil(F.size("all") * PERCENT / 100)
    taken = F.slice("all", F.lit(1), (F.size("all") - shared + 1).cast("int"))
    return ordered.select("cid", F.explode(taken).alias("one")).filter("one.c > 1").select(F.col("one.s").alias("key"), "cid")


def _chunk_links(table: pa.Table) -> pa.Table:
    """Links within the groups of a chunk (group, cid, root, line)."""
    cids, first, at = np.unique(table["cid"].to_numpy(), return_index=True, return_inverse=True)
    sets = [s for part in _slices(table["line"].take(pa.array(first)).to_pylist()) for s in shingle_sets(part)]
    group, roots = table["group"].to_numpy(), table["root"].to_numpy()
    order = np.argsort(group, kind="stable")
    found = []
    for rows in np.split(order, np.flatnonzero(np.diff(group[order])) + 1):
        if len(rows) > 1:
            members = at[rows]
            found += [(cids[members[x]], cids[members[y]]) for x, y in _group_links(roots[rows], [sets[i] for i in members])]
    left, right = zip(*found) if found else ((), ())
    return pa.table({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})


def _links(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """Links (a, b) of lines (cid, line) that share some of (key, cid, n, crowd)."""
    links = written(_verified(_stars(keys), texts), "line-links")
    roots = components(links).withColumnRenamed("node", "cid")
    rows = written(
        keys.join(roots, "cid", "left").select("key", "cid", "n", F.coalesce("root", "cid").alias("root")), "line-rooted"
    )
    # The star of two lines is the other one.
    whole = written(_open(rows, 3), "line-open")
    groups = _spread(rows, whole.filter("parts = 1"))
    # Lines of wide keys meet by rare shingles; what is still wide is cut.
    wide = whole.filter("parts > 1").select("key")
    if not wide.isEmpty():
        met = written(rows.join(wide, "key").select("cid", "n", "root").distinct(), "line-wide")
        narrow = written(_rarest(texts.join(met, "cid", "left_semi")).join(met, "cid").select("key", "cid", "n", "root"), "line-narrow")
        groups = groups.unionByName(_spread(narrow, written(_open(narrow, 2), "line-open")))
    groups = written(groups, "line-groups")
    chunks = max(parts_of(texts.sparkSession), (groups.agg(F.sum("n").alias("n")).first().n or 0) // PART_SHINGLES)
    named = groups.select(F.xxhash64("key", "i", "j").alias("group"), "cid", "root").join(texts.select("cid", "line"), "cid")
    found = (
        named.withColumn("chunk", F.pmod(F.col("group"), F.lit(chunks))).groupBy("chunk")
        .applyInArrow(_chunk_links, "a long, b long")
    )
    return links.unionByName(written(found, "line-links"))


def line_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lines, keepers): every line that is not blank, and for each class (h, g) that has more than
    one line in its component the place (absent, doc_id, line_no, t) of the line that stays."""
    lines = _lines(docs)
    classes = written(
        lines.groupBy("h", "g").agg(F.min(_place()).alias("first"), F.count("*").alias("n")), "line-classes"
    )
    owner_bits = max(1, power_of_two(max(parts_of(docs.sparkSession), classes.count() * BANDS / OWNER_KEYS)))
    sent = lines.select("h", "line").mapInArrow(_sender(owner_bits), _MESSAGE)
    shared = written(sent.groupBy("owner").applyInArrow(_shared, "key long, h long"), "line-keys")
    candidates = classes.join(shared.select("h").distinct(), "h", "left_semi").select("h", "g", "first.doc_id", "first.line_no")
    texts = (
        lines.join(candidates.select("h", "g", F.col("doc_id").alias("d"), F.col("line_no").alias("l")), ["h", "g"])
        .filter("doc_id <=> d AND line_no = l").groupBy("h", "g").agg(F.first("line").alias("line"))
    )
    texts = written(_sized(texts).withColumn("cid", F.monotonically_increasing_id()), "line-texts")
    crowds = shared.groupBy("key").agg(F.count("*").alias("c"))
    counted = shared.join(crowds, "key").join(texts.select("h", "cid", "n"), "h")
    # A line has no more keys than bands.
    crowd = counted.groupBy("cid").agg(F.sum("c").alias("crowd"))
    keys = written(counted.select("key", "cid", "n").join(crowd, "cid"), "line-candidates")
    roots = components(_links(texts, keys)).withColumnRenamed("node", "cid")
    linked = texts.join(roots, "cid").select("h", "g", "root")
    joined = written(classes.join(linked, ["h", "g"], "left").filter("n > 1 OR root IS NOT NULL"), "line-joined")
    first = joined.filter("root IS NOT NULL").groupBy("root").agg(F.min("first").alias("least"))
    keepers = joined.join(first, "root", "left").select("h", "g", F.coalesce("least", "first").alias("stays"))
    return lines, written(keepers, "line-keepers")


def _dropped(docs: DataFrame) -> DataFrame:
    """(doc_id, t, dropped): the numbers of the dropped lines, ascending, of every document that has any."""
    lines, keepers = line_classes(docs)
    return (
        lines.select("doc_id", "t", "line_no", "h", "g").join(keepers, ["h", "g"]).filter(_place() != F.col("stays"))
        .groupBy("doc_id", "t")
        .agg(F.array_sort(F.collect_set("line_no")).alias("dropped"))
    )


def dedup_lines(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_kept and the numbers of the dropped lines, ascending, of every row."""
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(*_document(docs), F.size(F.split(text, "\n")).cast("long").alias("n_lines"))
    report = _dropped(docs).select(F.col("doc_id").alias("_id"), F.col("t").alias("_t"), "dropped")
    named = rows["doc_id"].eqNullSafe(report["_id"]) & (rows["t"] == report["_t"])
    return rows.join(report, named, "left").select(
        "doc_id", "n_lines",
        (F.col("n_lines") - F.coalesce(F.size("dropped"), F.lit(0))).alias("n_kept"),
        F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"),
    )


def rewritten(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the dropped lines taken out of their texts."""
    report = _dropped(docs).select(F.col("doc_id").alias("_id"), F.col("t").alias("_t"), F.col("dropped").alias("_dropped"))
    kept = F.filter(F.split("text", "\n"), lambda line, i: ~F.array_contains(F.col("_dropped"), i))
    text = F.when(F.col("_dropped").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    doc_id, t = _document(docs)
    return docs.join(report, doc_id.eqNullSafe(report["_id"]) & (t == report["_t"]), "left").withColumn("text", text).select(*docs.columns)
