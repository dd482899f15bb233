"""MinHash near-duplicate detection by fast similarity sketching, banding and exact verification.

Each text's set of word shingles is sketched into T coordinates: in round r every element is thrown into one
bin, later rounds only matter for bins that are still empty, and rounds T..2T-1 throw everything into bin
r - T, so every coordinate is filled and estimates keep Chernoff-like concentration. Bands of coordinates
find candidates, full sets confirm them.

Texts with equal sets are one class from the start. A class is compared first with one class that it shares a
bucket with, the one with most such neighbours (a star's centre; in a group of edits mostly their original).
Afterwards only buckets that still hold several components are compared across components, each pair in its
first common bucket, and of a bucket's largest component only against the rest. A pair is ruled out inside the
task by the sizes of both sets, by the sketch, by a common centre, and last by the multisets of 16 bits of every
shingle's hash, whose overlap can't be less than that of the sets. What is left names one pair for each two
components of the bucket, so a task gives out fewer pairs than it has rows. Named pairs are confirmed on the
full sets; if one fails, all pairs that are left are named and confirmed. Links inside one component cannot
change any answer, so no component is lost and a large group costs a star, not all its pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogue_etl.llm.common import BLOCK_ROWS, connected_components, drop, local_roots, materialize, run_starts, whole_runs
from dialogue_etl.llm.textkit import mix, shingle_sets, slices

BANDS, ROWS = 32, 5
COORDINATES = BANDS * ROWS
#: A pair whose share of equal coordinates is this far below the threshold is given up. One standard deviation of
#: the estimate at the threshold is 0.025 as measured (coordinates are drawn without replacement; independent
#: ones would have 0.032), so a true pair is given up less than once in a million.
SLACK = 0.125
#: Members of one star that are verified in one task.
STAR_ROWS = 512

_SEEDS = mix(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def sketch(values: np.ndarray, ends: np.ndarray, t: int = COORDINATES) -> np.ndarray:
    """The sketch, one row of t 64-bit coordinates for every set; an empty set's row is all ones."""
    n = len(ends) - 1
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full((n, t), full, np.uint64)
    flat = out.reshape(-1)
    owner = np.repeat(np.arange(n), np.diff(ends))
    open_values, open_owner = values, owner
    for r in range(2 * t):
        if not len(open_values):
            break
        h = mix(open_values ^ _SEEDS[r])
        if r < t:
            bins = ((h >> np.uint64(32)) * np.uint64(t)) >> np.uint64(32)
        else:
            bins = np.full(len(h), r - t, np.uint64)
        rank = (h & np.uint64(0xFFFFFFFF)) | np.uint64(r << 32)
        np.minimum.at(flat, open_owner * t + bins.astype(np.int64), rank)
        todo = (out == full).any(axis=1)[open_owner]
        open_values, open_owner = open_values[todo], open_owner[todo]
    return out


def band_keys(sketches: np.ndarray) -> np.ndarray:
    keys = np.zeros((len(sketches), BANDS), np.uint64)
    for k in range(ROWS):
        keys = mix(keys * np.uint64(0xD6E8FEB86659FD93) + sketches[:, k::ROWS][:, :BANDS] + np.uint64(k + 1))
    return keys


def _sketched(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, z, data, ends in slices(batch.column(1)):
                s, at = shingle_sets(data, ends, width)
                marks = sketch(s, at)
                keys, low = band_keys(marks).astype(np.int64), (mix(marks) & np.uint64(0xFF)).astype(np.uint8)
                sizes = np.diff(at)
                short = (s & np.uint64(0xFFFF)).astype("<u2")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, z - a),
                        batch.column(2).slice(a, z - a),
                        batch.column(3).slice(a, z - a),
                        pa.array(sizes, pa.int64()),
                        pa.array([hashlib.blake2b(s[i:j].tobytes(), digest_size=16).digest() if j > i else None for i, j in zip(at[:-1], at[1:])], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * BANDS, pa.int32()), pa.array(keys.reshape(-1))),
                        pa.array([x.tobytes() for x in low], pa.binary()),
                        pa.array([x.tobytes() for x in np.split(short, at[1:-1])], pa.binary()),
                    ],
                    names=["id", "text_mark", "row", "n_shingles", "digest", "bands", "marks", "short"],
                )

    return run


def _verified(width: int, percent: int):
    """Streams over rows sorted by (star, part, role): role 0 is the star's centre, role 1 its members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, centre_of = np.zeros(0, np.uint64), None
        for batch in batches:
            star, role, ids = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("star", "role", "id"))
            a_out, b_out, far, linked = [], [], [], []
            for a, z, data, ends in slices(batch.column("text")):
                s, at = shingle_sets(data, ends, width)
                for k in range(a, z):
                    own = s[at[k - a] : at[k - a + 1]]
                    if role[k] == 0:
                        centre, centre_of = own.copy(), star[k]
                    elif star[k] == centre_of and len(own):
                        small, large = (own, centre) if len(own) <= len(centre) else (centre, own)
                        spot = np.searchsorted(large, small)
                        spot[spot == len(large)] = 0
                        both = int((large[spot] == small).sum())
                        either = len(own) + len(centre) - both
                        a_out.append(ids[k])
                        b_out.append(star[k])
                        far.append(1 - both / either)
                        linked.append(100 * both >= percent * either)
            yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64()), pa.array(far, pa.float64()), pa.array(linked, pa.bool_())], names=["a", "b", "far", "linked"])

    return run


def _ranked(short: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Each set's values made distinct by their place among equal ones, so that sets of them overlap as multisets do."""
    owner = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    order = np.lexsort((short, owner))
    same = np.zeros(len(short), bool)
    same[1:] = (short[order][1:] == short[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    spot = np.arange(len(short))
    place = spot - np.maximum.accumulate(np.where(same, 0, spot))
    out = np.empty(len(short), np.int64)
    out[order] = short[order].astype(np.int64) | (place << 16)
    return out


def _across(threshold: float, percent: int, most_far: float, exact: bool):
    """Pairs (a, star) of different components inside each bucket that no bound rules out, each pair in its first
    common band only. Where both have been measured against the same centre, a difference of their distances from
    it beyond most_far rules the pair out: the distance is a metric. A pair joins its two components for the rest of
    the bucket, so at most one pair for each component is given. The column short holds 16 bits of each shingle, with
    exact all 64: then only pairs that reach the threshold are given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["band", "key", "blk_i", "blk_j"]
        for table in whole_runs(batches, names):
            columns = {c: table.column(c).to_numpy() for c in (*names, "blk", "id", "component", "centre", "far", "n_shingles")}
            marks = np.frombuffer(b"".join(table.column("marks").to_pylist()), np.uint8).reshape(-1, COORDINATES)
            bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
            raw = table.column("short").to_pylist()
            ends = np.concatenate([[0], np.cumsum(columns["n_shingles"])])
            ranked = np.unique(np.frombuffer(b"".join(raw), "<u8"), return_inverse=True)[1] if exact else _ranked(np.frombuffer(b"".join(raw), "<u2"), ends)
            present = np.zeros(int(ranked.max(initial=0)) + 1, bool)
            starts = run_starts([columns[c] for c in names])
            found_a, found_b = [], []
            for a, z in zip(starts, [*starts[1:], len(marks)]):
                ids, label, blk, centre, far, n = (columns[c][a:z] for c in ("id", "component", "blk", "centre", "far", "n_shingles"))
                label = label.copy()
                m, keys, band = marks[a:z], bands[a:z], columns["band"][a]
                split = columns["blk_i"][a] != columns["blk_j"][a]
                for k in range(len(ids)):
                    other = (label != label[k]) & (ids > ids[k])
                    if split:
                        other &= blk != blk[k]
                    other &= (100 * np.minimum(n, n[k]) >= percent * np.maximum(n, n[k])) & ~((centre == centre[k]) & (np.abs(far - far[k]) > most_far))
                    other = np.flatnonzero(other)
                    if len(other):
                        other = other[(m[other] == m[k]).mean(axis=1) >= threshold]
                    if len(other):
                        other = other[(keys[other] == keys[k]).argmax(axis=1) == band]
                    if not len(other):
                        continue
                    present[ranked[ends[a + k] : ends[a + k + 1]]] = True
                    both = np.array([np.count_nonzero(present[ranked[ends[a + j] : ends[a + j + 1]]]) for j in other])
                    present[ranked[ends[a + k] : ends[a + k + 1]]] = False
                    other = other[100 * both >= percent * (n[other] + n[k] - both)]
                    if len(other):
                        joined, first = np.unique(label[other], return_index=True)
                        other = other[first]
                        label[np.isin(label, joined)] = label[k]
                    found_a.append(ids[other])
                    found_b.append(np.full(len(other), ids[k]))
            pair = [np.concatenate([np.zeros(0, np.int64), *x]) for x in (found_a, found_b)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in pair], names=["a", "star"])

    return run


def _full_sets(width: int):
    """(id, short): all 64 bits of the shingles of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, z, data, ends in slices(batch.column("text")):
                s, at = shingle_sets(data, ends, width)
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(a, z - a), pa.array([s[at[k] : at[k + 1]].astype("<u8").tobytes() for k in range(z - a)], pa.binary())], names=["id", "short"])

    return run


def _dealt(placed: DataFrame, name: str) -> DataFrame:
    """The rows (id, band, key, component) of buckets with several components, dealt to pairs of blocks.

    A bucket's largest component is never compared with itself: its blocks meet the blocks of the rest only, so
    its rows are copied as often as the rest has blocks, however large the component is.
    """
    sizes = placed.groupBy("band", "key", "component").agg(F.count("*").alias("n"))
    top = F.max(F.struct("n", "component"))
    mixed = sizes.groupBy("band", "key").agg(F.sum("n").alias("size"), top.alias("top"), F.count("*").alias("parts")).filter("parts > 1")
    mixed = materialize(mixed.select("band", "key", "size", F.col("top.component").alias("main"), F.col("top.n").alias("main_size")), name)
    whole = F.col("size") <= BLOCK_ROWS
    is_main = F.col("component") == F.col("main")
    mains, rest = (F.ceil(x / F.lit(BLOCK_ROWS)).cast("int") for x in (F.col("main_size"), F.col("size") - F.col("main_size")))
    h = F.xxhash64("id")
    own = F.when(whole, 0).when(is_main, F.pmod(h, mains)).otherwise(mains + F.pmod(h, rest)).cast("int")
    others = F.when(whole, F.array(F.lit(0))).when(is_main, F.sequence(mains, mains + rest - 1)).otherwise(F.sequence(F.lit(0), mains + rest - 1))
    rows = placed.join(mixed, ["band", "key"]).select("id", "band", "key", "component", own.alias("blk"), F.explode(others).alias("other"))
    return rows.select("id", "band", "key", "component", "blk", F.least("blk", "other").alias("blk_i"), F.greatest("blk", "other").alias("blk_j"))


def _confirm(pairs: DataFrame, names: DataFrame, texts: DataFrame, width: int, percent: int, name: str, few: bool = False) -> DataFrame:
    """The pairs (a, star) with their distance and whether their full sets reach the threshold; each star is
    verified in parts of bounded size. names gives each class's document and text mark, by which texts are found."""
    parts = pairs.groupBy("star").count().select("star", F.ceil(F.col("count") / STAR_ROWS).cast("int").alias("parts"))
    parts = materialize(parts, f"{name}-stars")
    members = pairs.join(parts, "star").select("star", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("role"), F.col("a").alias("id"))
    centres = parts.select("star", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role"), F.col("star").alias("id"))
    listed = members.unionByName(centres).join(names, "id")
    if few:
        # Written first: a list that is short by its size on disk meets the texts without a shuffle of all of them.
        listed = materialize(listed, f"{name}-rows")
    rows = listed.join(texts, ["doc", "text_mark"])
    rows = rows.repartition("star", "part").sortWithinPartitions("star", "part", "role")
    out = materialize(rows.select("star", "role", "id", "text").mapInArrow(_verified(width, percent), "a long, b long, far double, linked boolean"), f"{name}-links")
    drop(parts)
    drop(listed)
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """Returns (id, n_shingles, component_id, kept) for every row of docs.

    Two texts are linked if 100 * |intersection| >= percent * |union| of their sets of `width`-word shingles
    (lower-cased, words between white space; a shorter text is one shingle). component_id is the smallest id
    reachable over links. Defined cases: a null or empty text has an empty set, no link and itself as its
    component; a row with a null id keeps a null component_id and kept = true and links with nothing; rows
    that repeat an id are answered row by row, each by its own text (equal rows get equal answers); other
    columns are ignored.
    """
    base, rooted = _rooted(docs, id_col, text_col, width, percent, null_ids=False)
    lowest = materialize(rooted.groupBy("root").agg(F.min("class_id").alias("component")), "mh-lowest")
    named = materialize(rooted.join(lowest, "root").select(F.col("digest").alias("class_digest"), "component"), "mh-answer")
    out = base.select("id", "n_shingles", "digest").join(named, F.col("digest") == F.col("class_digest"), "left")
    component = F.when(F.col("id").isNull(), F.lit(None).cast("long")).otherwise(F.coalesce("component", "id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def _rooted(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int, null_ids: bool) -> tuple[DataFrame, DataFrame]:
    """The sketched rows (id, text_mark, n_shingles, digest) and, for every class of equal sets, (digest, class_id,
    class_mark, root): its first row, rows without an id last, and its component. text_mark tells apart the texts
    of one id; null_ids says whether rows without an id belong to classes."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_mark"))
    numbered = texts.withColumn("row", F.monotonically_increasing_id())
    base = materialize(numbered.mapInArrow(_sketched(width), "id long, text_mark long, row long, n_shingles long, digest binary, bands array<long>, marks binary, short binary"), "mh-sketch")
    own = base.filter("digest IS NOT NULL") if null_ids else base.filter("digest IS NOT NULL AND id IS NOT NULL")
    # Equal sets are one class; its first row stands for it, and that row's number, fixed by the write, is its key.
    first = own.groupBy("digest").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_mark", "row")).alias("first"))
    classes = materialize(first.select("digest", F.col("first.row").alias("key"), F.col("first.id").alias("class_id"), F.col("first.text_mark").alias("class_mark")), "mh-classes")
    named = classes.select("key", F.col("digest").alias("class_digest"))
    # Only the numbers of the copies meet the sketches, so these aren't shuffled where copies are few.
    copies = materialize(own.select("row", "digest").join(named, (F.col("digest") == F.col("class_digest")) & (F.col("row") != F.col("key"))).select("row"), "mh-copies")
    reps = materialize(own.join(copies, "row", "left_anti").select(F.col("row").alias("id"), "n_shingles", "bands", "marks", "short"), "mh-reps")
    lite = materialize(base.select("id", "text_mark", "n_shingles", "digest"), "mh-rows")
    drop(base)
    # Texts are found by the id (0 for none: the mark tells them apart) and the mark.
    names = classes.select(F.col("key").alias("id"), F.coalesce("class_id", F.lit(0)).alias("doc"), F.col("class_mark").alias("text_mark"))
    # Of rows that repeat both, one text is read; where none does, this is a look-up in an empty table.
    texts = texts.withColumn("doc", F.coalesce("doc", F.lit(0)))
    repeats = lite.filter("digest IS NOT NULL").groupBy(F.coalesce("id", F.lit(0)).alias("doc"), "text_mark").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    repeats = materialize(repeats, "mh-repeats")
    found = ["doc", "text_mark"]
    texts = texts.join(repeats, found, "left_anti").select(*found, "text").unionByName(texts.join(repeats, found, "left_semi").select(*found, "text").dropDuplicates(found))

    banded = reps.select("id", F.posexplode("bands").alias("band", "key"))
    buckets = materialize(banded.groupBy("band", "key").agg(F.count("*").alias("bucket_size")).filter("bucket_size > 1"), "mh-buckets")
    shared = materialize(banded.join(buckets, ["band", "key"]), "mh-shared")
    # The member with most neighbours leads a bucket; each class takes the leader with most of all its buckets.
    known = materialize(shared.groupBy("id").agg(F.sum("bucket_size").alias("known")), "mh-known")
    leads = shared.join(known, "id").groupBy("band", "key").agg(F.max(F.struct("known", (-F.col("id")).alias("minus"))).alias("lead"))
    stars = shared.join(materialize(leads, "mh-leads"), ["band", "key"]).groupBy("id").agg(F.max("lead").alias("lead"))
    stars = materialize(stars.select(F.col("id").alias("a"), (-F.col("lead.minus")).alias("star")).filter("a <> star"), "mh-stars")
    marks_a = reps.select(F.col("id").alias("a"), F.col("marks").alias("marks_a"))
    marks_b = reps.select(F.col("id").alias("star"), F.col("marks").alias("marks_b"))
    near = materialize(stars.join(marks_a, "a").join(marks_b, "star").select("a", "star", "marks_a", "marks_b").mapInArrow(_alike(percent / 100 - SLACK), "a long, star long"), "mh-alike")
    measured = _confirm(near, names, texts, width, percent, "mh-round1")
    comps = materialize(connected_components(measured.filter("linked").select("a", "b"), "mh-cc1"), "mh-comps")
    for used in (buckets, known, stars, near):
        drop(used)

    # Buckets that still hold several components: pairs across them.
    centres = measured.select(F.col("b").alias("id")).distinct()
    far = measured.select(F.col("a").alias("id"), F.col("b").alias("centre"), "far").join(centres, "id", "left_anti").unionByName(centres.select("id", F.col("id").alias("centre"), F.lit(0.0).alias("far")))
    far = materialize(far, "mh-far")
    order = ["band", "key", "blk_i", "blk_j"]
    looked = shared
    for exact in (False, True):
        placed = looked.join(comps, looked.id == comps.node, "left").select("id", "band", "key", F.coalesce("component", "id").alias("component"))
        placed, before = materialize(placed, "mh-placed"), comps
        known = reps
        if exact:
            # Written first, as in _confirm: a short list meets the texts without a shuffle of all of them.
            listed = materialize(placed.select("id").distinct().join(names, "id"), "mh-listed")
            full = materialize(listed.join(texts, ["doc", "text_mark"]).select("id", "text").mapInArrow(_full_sets(width), "id long, short binary"), "mh-full")
            known = reps.drop("short").join(full, "id")
        rows = _dealt(placed, "mh-mixed").join(known, "id").join(far, "id", "left").fillna({"centre": -1, "far": 0.0})
        # Bands and sets are read from the table of classes; no component is compared with itself.
        rows = rows.repartition(*order).sortWithinPartitions(*order)
        more = rows.mapInArrow(_across(percent / 100 - SLACK, percent, 1 - percent / 100 + 1e-9, exact), "a long, star long")
        more = materialize(more.distinct(), "mh-across")
        drop(placed)
        if exact:
            comps = _merged(before, more.select("a", F.col("star").alias("b")))
            drop(full)
            break
        late = _confirm(more, names, texts, width, percent, "mh-round2", few=True)
        comps = _merged(before, late.filter("linked"))
        drop(before)
        failed = materialize(late.filter("NOT linked").select("a", "b"), "mh-failed")
        if failed.isEmpty():
            break
        # A pair that failed stood for its components in the buckets that it shares: these are compared again.
        left, right = shared.select(F.col("id").alias("a"), "band", "key"), shared.select(F.col("id").alias("b"), "band", "key")
        again = materialize(left.join(failed, "a").join(right, ["b", "band", "key"]).select("band", "key").distinct(), "mh-again")
        looked = materialize(shared.join(again, ["band", "key"], "left_semi"), "mh-looked")
    for used in (shared, reps, far, measured):
        drop(used)
    rooted = classes.join(comps, classes.key == comps.node, "left").select("digest", "class_id", "class_mark", F.coalesce("component", "key").alias("root"))
    return lite, materialize(rooted, "mh-roots")


def _merged(comps: DataFrame, links: DataFrame) -> DataFrame:
    """The components (node, component) after more links (a, b)."""
    named_a = comps.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    named_b = comps.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    joined = links.join(named_a, "a", "left").join(named_b, "b", "left")
    second = materialize(connected_components(joined.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")), "mh-cc2"), "mh-comps2")
    moved = comps.join(second.select(F.col("node").alias("component"), F.col("component").alias("whole")), "component", "left")
    moved = moved.select("node", F.coalesce("whole", "component").alias("component"))
    return materialize(moved.unionByName(second.join(comps, "node", "left_anti").select("node", "component")), "mh-comps")


def _alike(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, COORDINATES) for c in ("marks_a", "marks_b"))
            keep = pa.array((x == y).mean(axis=1) >= threshold)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "star")], names=["a", "star"])

    return run


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """docs with exactly one row of each group of near duplicates, whole and with all its columns.

    The row with the smallest id stays; rows without an id are documents too and come last. Of rows that repeat
    an id and its text one stays. Each text of a repeated id is judged by itself. Rows without a word all stay.
    """
    base, rooted = _rooted(docs, id_col, text_col, width, percent, null_ids=True)
    lead = F.min(F.struct(F.col("class_id").isNull().alias("no_id"), F.col("class_id").alias("lead_id"), F.col("class_mark").alias("lead_mark")))
    leads = materialize(rooted.groupBy("root").agg(lead.alias("lead")).select("root", "lead.lead_id", "lead.lead_mark"), "mh-leads")
    led = rooted.join(leads, "root").select(F.col("digest").alias("class_digest"), "lead_id", "lead_mark")
    rows = base.filter("digest IS NOT NULL").groupBy("id", "text_mark").agg(F.first("digest").alias("digest"), F.count("*").alias("times"))
    judged = rows.join(led, F.col("digest") == F.col("class_digest")).select("id", "text_mark", "times", (F.col("id").eqNullSafe(F.col("lead_id")) & (F.col("text_mark") == F.col("lead_mark"))).alias("leads"))
    judged = materialize(judged.filter("NOT leads OR times > 1").select(F.col("id").alias("__id"), F.col("text_mark").alias("__mark"), "leads"), "mh-judged")
    same = docs[id_col].cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(docs[text_col]) == F.col("__mark"))
    out = docs.join(judged.drop("leads"), same, "left_anti")
    again = judged.filter("leads").drop("leads")
    if again.isEmpty():
        return out
    # One row of each set of rows that repeat an id and its text: the least by a hash of its columns.
    named = [docs[c].alias(f"c{k}") for k, c in enumerate(docs.columns)]
    plain = [docs[c] for c in docs.columns if "map<" not in dict(docs.dtypes)[c]]
    packed = docs.select(docs[id_col].cast("long").alias("__i"), F.xxhash64(docs[text_col]).alias("__m"), F.xxhash64(*plain).alias("__h"), F.struct(*named).alias("__row"))
    packed = packed.join(again, F.col("__i").eqNullSafe(F.col("__id")) & (F.col("__m") == F.col("__mark")), "left_semi")
    one = packed.groupBy("__i", "__m").agg(F.min_by("__row", "__h").alias("__row"))
    return out.unionByName(one.select(*[F.col(f"__row.c{k}").alias(c) for k, c in enumerate(docs.columns)]))


def op10_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """near_duplicates() of all documents: two words a shingle, similarity 0.8. Null and empty texts have no
    shingle and stay; repeated rows are answered alike; null ids have a null component."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), width=2, percent=80)


SQL = """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, hash(x) AS x FROM (SELECT doc_id, unnest(CASE WHEN len(w) = 1 THEN [w[1]] ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS x FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
p AS (SELECT i.a, i.b FROM i JOIN n x ON i.a = x.doc_id JOIN n y ON i.b = y.doc_id WHERE 100 * i.both >= 80 * (x.n + y.n - i.both)),
l AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
reach(id, r) AS (SELECT doc_id, doc_id FROM w UNION SELECT l.a, reach.r FROM reach JOIN l ON l.b = reach.id),
c AS (SELECT id, min(r) AS component_id FROM reach GROUP BY id)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, w.doc_id = c.component_id AS kept FROM w JOIN c ON w.doc_id = c.id LEFT JOIN n ON w.doc_id = n.doc_id
"""
