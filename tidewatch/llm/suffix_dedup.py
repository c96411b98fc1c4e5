"""Removal of repeated byte strings by a distributed difference-cover suffix sort.

Rule: each byte covered by a ``WIDTH``-byte string that also starts in a
document with a smaller id is removed (judged on the input; matches stay within
documents).

Method. Only the first ``WIDTH`` bytes of a suffix matter, which bounds the
recursion of the difference-cover algorithm.

1. Equal texts are one class, judged by its smallest id; its other documents
   are removed whole.
2. Reduction without loss: the least hash of the ``GRAM``-byte strings of a
   window marks it. Windows whose mark no other class has cannot repeat, and
   are left out of the sort.
3. Sampled suffixes are those at 1 or 2 modulo 3 (the difference cover). A
   block of 16 bytes has a name; a sampled triple is three such blocks, and its
   name is made of their names (the recursion; 48 bytes).
4. Triples are dealt to bins by name and sorted there. Two equal windows have a
   shift of 0, 1 or 2 bytes at which both suffixes are sampled, so the
   remaining suffixes merge as (bytes before, triple's name, bytes after);
   neighbours in the order with equal first ``WIDTH`` bytes share a string, and
   the smaller id stays.
5. The answers go back to the texts, overlapping windows merge to spans.

Names are 64-bit fingerprints, so equal names need no numbering over the whole
corpus, and the bins' order is by fingerprint instead of by byte; only equality
of prefixes is asked. Equal triples of a task are sent once, with their least
id, so a passage that stands everywhere costs one entry per task.

Rows travel as packed arrays. A bin or a group of texts is one of as many as
there are shuffle partitions, which bounds what a task holds.

Defined results: a null text is the empty text; a row with a null id takes no
part (nothing removed, no witness); rows that repeat an id never remove each
other; texts below ``WIDTH`` bytes stay; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow_text import flat_bytes, row_slices

WIDTH = 50
GRAM = 24
BLOCK = 16
SLICE = 1 << 16  # bytes that are hashed at a time, so that the arrays stay in a core's cache
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _power(n: int) -> np.uint64:
    return _U(pow(_BASE, n, 1 << 64))


def _block_names(data: np.ndarray) -> dict[int, np.ndarray]:
    """Names of all strings of 1, 2, 4, 8 and 16 bytes (polynomials modulo 2 ** 64)."""
    names = {1: data.astype(np.uint64) + _U(1)}
    for size in (1, 2, 4, 8):
        x = names[size]
        names[2 * size] = x[:-size] * _power(size) + x[size:] if len(x) > size else x[:0]
    return names


def _joined(a: np.ndarray, b: np.ndarray, shift: int, width: int) -> np.ndarray:
    """Names of the strings made of one of ``a`` and, ``shift`` bytes on, one of ``b`` of ``width`` bytes."""
    n = max(0, min(len(a), len(b) - shift))
    return a[:n] * _power(width) + b[shift : shift + n]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(32))


def marks(names: dict[int, np.ndarray]) -> np.ndarray:
    """The mark of the window at each place: the least hash of its GRAM-byte strings."""
    m = _mixed(_joined(names[16], names[8], 16, 8))
    span, size = WIDTH - GRAM + 1, 1
    if len(m) < span:
        return m[:0]
    n = len(m) - span + 1
    while 2 * size <= span:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    return np.minimum(m[:n], m[span - size : span - size + n])


def triples(names: dict[int, np.ndarray], at: np.ndarray) -> np.ndarray:
    """Names of the triples of blocks that start at the places ``at``."""
    block = names[BLOCK]
    two = block[at] * _power(BLOCK) + block[at + BLOCK]
    return _mixed(_mixed(two * _power(BLOCK) + block[at + 2 * BLOCK]) * _U(0x94D049BB133111EB))


def _window_count(offsets: np.ndarray) -> np.ndarray:
    return np.maximum(np.diff(offsets) - WIDTH + 1, 0)


def _codes(m: np.ndarray, bins: int) -> np.ndarray:
    """A mark as its bin and 32 bits."""
    return ((m >> _U(32)) % _U(bins) << _U(32)) | (m & _U(0xFFFFFFFF))


def _first_of_runs(*sorted_keys: np.ndarray) -> np.ndarray:
    n = len(sorted_keys[0])
    first = np.ones(n, bool)
    if n:
        first[1:] = False
        for k in sorted_keys:
            first[1:] |= k[1:] != k[:-1]
    return first


def _ranges(counts: np.ndarray) -> np.ndarray:
    """0 .. count - 1 for each count, joined."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


# --- step 2: marks shared by classes ----------------------------------------------------

_MARK_SCHEMA = "bin int, kind int, a binary, b binary, n binary"


def _mark_row(key, kind, a, b=b"", n=b""):
    return (int(key), kind, a.tobytes(), b if isinstance(b, bytes) else b.tobytes(), n if isinstance(n, bytes) else n.tobytes())


def _batch_of(rows: list, names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)


def _marks_of_batch(bins: int, groups: int):
    """Per batch and bin: marks of each class (kind 0), marks that classes of the batch share (1, once),
    and, for the groups of texts, what is known to be shared (2)."""

    def run(batches):
        for batch in batches:
            classes, first = np.unique(batch.column("c").to_numpy(), return_index=True)
            data, off = flat_bytes(batch.column("text").take(pa.array(first)))
            codes, owners = [], []
            for a, b in row_slices(off, SLICE):
                o = off[a : b + 1] - off[a]
                m = marks(_block_names(data[off[a] : off[b]]))
                count = _window_count(o)
                at = np.repeat(o[:-1], count) + _ranges(count)
                own, code = np.repeat(np.arange(a, b), count), _codes(m[at], bins)
                new = _first_of_runs(own, code)  # runs of windows with one mark
                codes.append(code[new])
                owners.append(own[new])
            code, own = np.concatenate([*codes, np.zeros(0, np.uint64)]), np.concatenate([*owners, np.zeros(0, np.int64)])
            order = np.lexsort((own, code))
            code, own = code[order], own[order]
            keep = _first_of_runs(code, own)
            code, own = code[keep], own[keep]
            starts = np.flatnonzero(_first_of_runs(code))
            times = np.diff(np.r_[starts, len(code)])
            local = np.repeat(times > 1, times)
            rows = []
            # known already: to the texts, and once to the bin
            known, to = code[local], classes[own[local]]
            group = to % groups
            order = np.argsort(group, kind="stable")
            for g, part in _parts(group[order]):
                # any bin hands it on
                rows.append((int(g) % bins, 2, to[order][part].tobytes(), known[order][part].tobytes(), int(g).to_bytes(4, "little")))
            shared = code[starts[times > 1]]
            for g, part in _parts((shared >> _U(32)).astype(np.int64)):
                rows.append(_mark_row(g, 1, (shared[part] & _U(0xFFFFFFFF)).astype(np.uint32)))
            # the rest: by bin, then class
            code, own = code[~local], own[~local]
            bin_of = (code >> _U(32)).astype(np.int64)
            order = np.lexsort((own, bin_of))
            bin_of, own, low = bin_of[order], own[order], (code[order] & _U(0xFFFFFFFF)).astype(np.uint32)
            for g, part in _parts(bin_of):
                s = np.flatnonzero(_first_of_runs(own[part]))
                rows.append(_mark_row(g, 0, low[part], classes[own[part][s]], np.diff(np.r_[s, len(own[part])]).astype(np.uint32)))
            yield _batch_of(rows, ["bin", "kind", "a", "b", "n"], [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()])

    return run


def _parts(sorted_keys: np.ndarray):
    """(key, slice) of each run of equal keys."""
    starts = np.flatnonzero(_first_of_runs(sorted_keys))
    for a, b in zip(starts, [*starts[1:], len(sorted_keys)], strict=False):
        yield sorted_keys[a], slice(a, b)


_GROUP_SCHEMA = "grp int, bin int, a binary, b binary"
_GROUP_KINDS = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]


def _shared_marks(groups: int):
    """Of one bin: (class, mark) wherever two classes have the mark, dealt to the groups of texts."""

    def run(table: pa.Table) -> pa.Table:
        lows, classes, common, rows = [], [], [], []
        key = table.column("bin")[0].as_py()
        for kind, a, b, n in zip(*(table.column(c).to_pylist() for c in ("kind", "a", "b", "n")), strict=True):
            if kind == 2:
                rows.append((int.from_bytes(n, "little"), -1, a, b))
            elif kind == 1:
                common.append(np.frombuffer(a, np.uint32))
            else:
                lows.append(np.frombuffer(a, np.uint32))
                classes.append(np.repeat(np.frombuffer(b, np.int64), np.frombuffer(n, np.uint32)))
        low, cls = np.concatenate([*lows, np.zeros(0, np.uint32)]), np.concatenate([*classes, np.zeros(0, np.int64)])
        order = np.argsort(low, kind="stable")
        low, cls = low[order], cls[order]
        starts = np.flatnonzero(_first_of_runs(low))
        times = np.diff(np.r_[starts, len(low)])
        # several entries of one class (copies in several batches) are one
        several = np.maximum.reduceat(cls, starts) != np.minimum.reduceat(cls, starts) if len(starts) else starts.astype(bool)
        several |= np.isin(low[starts], np.concatenate([*common, np.zeros(0, np.uint32)]))
        keep = np.repeat(several, times)
        low, cls = low[keep], cls[keep]
        code = (_U(key) << _U(32)) | low.astype(np.uint64)
        group = cls % groups
        order = np.argsort(group, kind="stable")
        for g, part in _parts(group[order]):
            rows.append((int(g), -1, cls[order][part].tobytes(), code[order][part].tobytes()))
        return pa.Table.from_batches([_batch_of(rows, ["grp", "bin", "a", "b"], _GROUP_KINDS)])

    return run


# --- steps 3 and 4: sampled triples -----------------------------------------------------


def _open_group(packed: pa.Table, known: pa.Table):
    """Of a group: class, id, bytes and offsets of its texts, one of each class, by id; and the
    shared marks with their range for each text. Depends on the contents only."""
    blobs = sorted(zip(*(packed.column(c).to_pylist() for c in ("ids", "cs", "sizes", "data")), strict=True))
    ids, cls, size = (np.concatenate([np.frombuffer(x[i], np.int64) for x in blobs]) for i in range(3))
    data = np.frombuffer(b"".join(zstandard.decompress(x[3]) for x in blobs), np.uint8)
    off = np.r_[0, np.cumsum(size)]
    order = np.lexsort((ids, cls))
    rep = order[_first_of_runs(cls[order])]
    rep = rep[np.lexsort((cls[rep], ids[rep]))]
    data = np.concatenate([data[off[k] : off[k + 1]] for k in rep])
    cls, ids, off = cls[rep], ids[rep], np.r_[0, np.cumsum(size[rep])]
    pairs = [(a, b) for n, a, b in zip(*(known.column(c).to_pylist() for c in ("bin", "a", "b")), strict=True) if n < 0]
    of, code = np.frombuffer(b"".join(p[0] for p in pairs), np.int64), np.frombuffer(b"".join(p[1] for p in pairs), np.uint64)
    order = np.lexsort((code, of))
    of, code = of[order], code[order]
    return cls, ids, data, off, code, np.searchsorted(of, cls), np.searchsorted(of, cls, "right")


def _entries(data, off, a, b, code, low, high, bins):
    """Entries of the texts a to b: place, text, name, context, flags (bit s: the window that
    starts s bytes before the place may repeat)."""
    o = off[a : b + 1] - off[a]
    part = data[off[a] : off[b]]
    names = _block_names(part)
    m = marks(names)
    may = np.zeros(len(part) + 2, np.uint8)  # windows that may repeat, by their start
    for k in range(b - a):
        own = code[low[a + k] : high[a + k]]
        end = o[k + 1] - WIDTH + 1
        if len(own) and end > o[k]:
            x = _codes(m[o[k] : end], bins)
            may[o[k] : end] = own[np.minimum(np.searchsorted(own, x), len(own) - 1)] == x
    flags = may.copy()
    flags[1:] |= may[:-1] << 1
    flags[2:] |= may[:-2] << 2
    at = np.flatnonzero(flags)
    row = np.searchsorted(o, at, "right") - 1
    inside = (at - o[row]) % 3 != 0
    at, row = at[inside], row[inside]
    flags = flags[at]
    wide = np.zeros(len(part) + 5, np.uint32)  # byte i stands at i + 2
    wide[2 : len(part) + 2] = part
    # bytes that none of the flagged windows holds count as 0
    zero, end = np.uint32(0), at + 2 + 3 * BLOCK
    context = (
        np.where(flags & 4, wide[at], zero) | np.where(flags & 6, wide[at + 1], zero) << np.uint32(8)
        | np.where(flags & 3, wide[end], zero) << np.uint32(16) | np.where(flags & 1, wide[end + 1], zero) << np.uint32(24)
    )
    return at + off[a], row + a, triples(names, at) if len(at) else np.zeros(0, np.uint64), context, flags


def _all_entries(data, off, code, low, high, bins):
    """Entries of all texts, in the order of the ids."""
    found = [_entries(data, off, a, b, code, low, high, bins) for a, b in row_slices(off, SLICE)]
    kinds = (np.int64, np.int64, np.uint64, np.uint32, np.uint8)
    return [np.concatenate([*(f[i] for f in found), np.zeros(0, k)]) for i, k in enumerate(kinds)]


def _distinct(name, context, flags):
    """Order in which equal entries stand together, by id; and the first of each equal run."""
    one = name * _U(_BASE) + (context.astype(np.uint64) << _U(8) | flags)
    order = np.argsort(_mixed(one), kind="stable")
    return order, _first_of_runs(name[order], context[order], flags[order])


def _sent(name, bins):
    """Order in which distinct entries (by id) are sent: by bin, then id."""
    bin_of = ((name >> _U(48)) % _U(bins)).astype(np.uint16 if bins <= 1 << 16 else np.int64)
    order = np.argsort(bin_of, kind="stable")
    return order, bin_of[order]


_ENTRY_SCHEMA = "bin int, grp int, name binary, context binary, flags binary, id binary, n binary"


def _send_triples(bins: int, mark_bins: int):
    def run(key, packed: pa.Table, known: pa.Table) -> pa.Table:
        rows = []
        if packed.num_rows and known.num_rows:
            _, ids, data, off, code, low, high = _open_group(packed, known)
            _, row, name, context, flags = _all_entries(data, off, code, low, high, mark_bins)
            order, first = _distinct(name, context, flags)
            one = np.sort(order[first])
            sent, bin_of = _sent(name[one], bins)
            one = one[sent]
            name, context, flags, doc = name[one], context[one], flags[one], ids[row[one]]
            for g, p in _parts(bin_of):
                s = np.flatnonzero(_first_of_runs(doc[p]))
                six = (name[p] & _U(0xFFFFFFFFFFFF)).view(np.uint8).reshape(-1, 8)[:, :6]
                rows.append((
                    int(g), key[0].as_py(), six.tobytes(), context[p].tobytes(), flags[p].tobytes(), doc[p][s].tobytes(),
                    np.diff(np.r_[s, len(doc[p])]).astype(np.uint32).tobytes(),
                ))
        names = [f.split()[0] for f in _ENTRY_SCHEMA.split(", ")]
        return pa.Table.from_batches([_batch_of(rows, names, [pa.int32()] * 2 + [pa.binary()] * 5)])

    return run


def _sort_triples(table: pa.Table) -> pa.Table:
    """Of one bin: for each entry, the windows (bits as in the flags) that also start in a smaller id."""
    col = {c: table.column(c).to_pylist() for c in table.column_names}
    sizes = [len(f) for f in col["flags"]]
    six = np.frombuffer(b"".join(col["name"]), np.uint8).reshape(-1, 6)
    name = np.zeros((len(six), 8), np.uint8)
    name[:, :6] = six
    name = name.reshape(-1).view(np.uint64)
    context = np.frombuffer(b"".join(col["context"]), np.uint32)
    flags = np.frombuffer(b"".join(col["flags"]), np.uint8)
    ids = np.repeat(np.frombuffer(b"".join(col["id"]), np.int64), np.frombuffer(b"".join(col["n"]), np.uint32))
    bits = np.zeros(len(name), np.uint8)
    order = np.argsort(name, kind="stable")
    s = name[order]
    same = np.zeros(len(s), bool)
    if len(s):
        same[1:] = s[1:] == s[:-1]
        same[:-1] |= same[1:]
    order = order[same]  # triples that stand alone equal nothing
    # Merge: the window of each shift as (triple, the bytes around it that it holds).
    for shift, mask in ((0, 0xFFFF0000), (1, 0x00FFFF00), (2, 0x0000FFFF)):
        own = order[(flags[order] >> shift) & 1 == 1]
        if not len(own):
            continue
        window = _mixed(name[own] * _U(_BASE) + (context[own] & np.uint32(mask)).astype(np.uint64))
        by = np.argsort(window)
        own, window = own[by], window[by]
        first = np.flatnonzero(_first_of_runs(window))
        least = np.repeat(np.minimum.reduceat(ids[own], first), np.diff(np.r_[first, len(own)]))
        bits[own[least < ids[own]]] |= 1 << shift
    ends = np.cumsum(sizes)
    rows = [(g, n, bits[e - k : e].tobytes(), b"") for g, n, e, k in zip(col["grp"], col["bin"], ends, sizes, strict=True)]
    return pa.Table.from_batches([_batch_of(rows, ["grp", "bin", "a", "b"], _GROUP_KINDS)])


# --- step 5: answers to spans -----------------------------------------------------------

_RESULT_SCHEMA = "c long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _cut_texts(bins: int, mark_bins: int, with_text: bool):
    def run(key, packed: pa.Table, known: pa.Table) -> pa.Table:
        rows = []
        if packed.num_rows and known.num_rows:
            cls, ids, data, off, code, low, high = _open_group(packed, known)
            at, row, name, context, flags = _all_entries(data, off, code, low, high, mark_bins)
            order, first = _distinct(name, context, flags)
            one = np.sort(order[first])
            sent, _ = _sent(name[one], bins)
            answers = sorted((n, a) for n, a in zip(known.column("bin").to_pylist(), known.column("a").to_pylist(), strict=True) if n >= 0)
            bits = np.zeros(len(at), np.uint8)  # of the entries that were sent
            bits[one[sent]] = np.frombuffer(b"".join(a for _, a in answers), np.uint8)
            # an entry of a larger id than the one sent repeats it within this group
            head = np.repeat(order[first], np.diff(np.r_[np.flatnonzero(first), len(order)]))
            answer = np.empty(len(at), np.uint8)
            answer[order] = np.where(ids[row[order]] > ids[row[head]], flags[order], bits[head])
            start = np.zeros(len(data) + WIDTH, np.int32)  # windows to remove, by their start, WIDTH places on
            for shift in range(3):
                start[at[(answer >> shift) & 1 == 1] - shift + WIDTH] = 1
            so_far = np.cumsum(start, dtype=np.int32)
            gone = so_far[WIDTH:] > so_far[: len(data)]
            hit = np.add.reduceat(gone, np.minimum(off[:-1], max(0, len(data) - 1)), dtype=np.int64)
            for k in np.flatnonzero(hit > 0):
                g = gone[off[k] : off[k + 1]]
                kept = data[off[k] : off[k + 1]][~g].tobytes()
                spans = int(g[0]) + int((g[1:] & ~g[:-1]).sum())
                rows.append((int(cls[k]), int(g.sum()), spans, hashlib.sha256(kept).hexdigest(), kept if with_text else None))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        return pa.Table.from_batches([_batch_of(rows, ["c", "n_removed", "n_spans", "kept_sha256", "kept"], kinds)])

    return run


_PACKED_SCHEMA = "grp int, ids binary, cs binary, sizes binary, data binary"


def _packed_texts(groups: int):
    """Per batch and group: ids, classes, sizes and compressed bytes of its texts; of equal texts the smallest id."""

    def run(batches):
        for batch in batches:
            c, ids = batch.column("c").to_numpy(), batch.column("doc_id").to_numpy()
            order = np.lexsort((ids, c))
            one = order[_first_of_runs(c[order])] if len(order) else order
            one = one[np.argsort(c[one] % groups, kind="stable")]
            data, off = flat_bytes(batch.column("text").take(pa.array(one)))
            c, ids, rows = c[one], ids[one], []
            for g, p in _parts(c % groups):
                blob = data[off[p.start] : off[p.stop]].tobytes()
                rows.append((int(g), ids[p].tobytes(), c[p].tobytes(), np.diff(off[p.start : p.stop + 1]).tobytes(), zstandard.compress(blob, 1)))
            yield _batch_of(rows, ["grp", "ids", "cs", "sizes", "data"], [pa.int32()] + [pa.binary()] * 4)

    return run


def repeated_strings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document; ``kept`` (bytes) where asked for."""
    groups = bins = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mark_bins = max(1, bins // 3)  # fewer, as each class is named once per bin
    keyed = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    ).withColumns({"c": F.xxhash64("text"), "n_bytes": F.octet_length("text").cast("long")})
    long = keyed.filter((F.col("n_bytes") >= WIDTH) & F.col("doc_id").isNotNull())

    found = (
        long.select("c", "text").mapInArrow(_marks_of_batch(mark_bins, groups), _MARK_SCHEMA)
        .groupBy("bin").applyInArrow(_shared_marks(groups), _GROUP_SCHEMA)
    )
    texts = long.select("doc_id", "c", "text").mapInArrow(_packed_texts(groups), _PACKED_SCHEMA).groupBy("grp")
    answers = (
        texts.cogroup(found.groupBy("grp")).applyInArrow(_send_triples(bins, mark_bins), _ENTRY_SCHEMA)
        .groupBy("bin").applyInArrow(_sort_triples, _GROUP_SCHEMA)
    )
    cut = texts.cogroup(found.unionByName(answers).groupBy("grp")).applyInArrow(_cut_texts(bins, mark_bins, with_text), _RESULT_SCHEMA)

    own = [F.sha2("text", 256).alias("sha"), *([F.col("text").cast("binary").alias("whole")] if with_text else [])]
    base = keyed.select("doc_id", "c", "n_bytes", *own)
    reps = long.groupBy("c").agg(F.min("doc_id").alias("rep"))
    rows = base.join(reps, "c", "left").join(cut, "c", "left")
    copy = F.coalesce((F.col("n_bytes") >= WIDTH) & (F.col("doc_id") > F.col("rep")), F.lit(False))
    part = F.col("doc_id").isNotNull() & F.col("n_removed").isNotNull()
    pick = lambda whole, some, none: F.when(copy, whole).when(part, some).otherwise(none)
    zero = F.lit(0).cast("long")
    out = [
        "doc_id", "n_bytes", pick(F.col("n_bytes"), F.col("n_removed"), zero).alias("n_removed"),
        pick(F.lit(1).cast("long"), F.col("n_spans"), zero).alias("n_spans"),
        pick(F.lit(_EMPTY_SHA), F.col("kept_sha256"), F.col("sha")).alias("kept_sha256"),
    ]
    if with_text:
        out.append(pick(F.lit("").cast("binary"), F.col("kept"), F.col("whole")).alias("kept"))
    return rows.select(*out)
