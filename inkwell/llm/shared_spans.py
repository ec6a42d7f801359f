"""Problem 2: stretches of text that stand letter for letter in more than one record.

1. Recurring passages are confirmed. Of every SPAN-character window of a text, the PHRASE characters
   with the least hash are its anchor (winnowing). Equal windows have equal anchors, so a phrase that
   is an anchor in one record only can't lie in a shared window as its anchor; the others recur. Each
   recurring phrase is taken from one record, its first; phrases of one stretch of one such record are a
   family, and families are spread over shards by hash.
2. The phrases of a shard are compiled into an Aho-Corasick automaton, and documents are streamed through
   it: each through those of all shards whose families its own fingerprints name. Step 1 keeps no place of
   a document but those that the phrases are cut from: where phrases occur, only the automata find.
3. The SPAN-character windows around the occurrences are compared over all records by 128 bits of hash,
   and then letter by letter with the record they were found equal to. The union of what is equal is the result.

Steps 1 and 3 ask the same of a key: does it occur in two records? A task first answers from its own
rows and passes on one row of a key it has answered; a key in a third of all records is then one row per
batch, and a family of its own in each batch.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwell.llm.bitmaps import Bitmap
from inkwell.session import written

SPAN = 200
PHRASE = 100
#: Characters that are hashed at once; longer texts are taken in overlapping parts.
_PART = 200_000
_MUL = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Phrases of an automaton, about so many at most: some 60 bytes a character of them.
SHARD_PHRASES = 20_000
#: Characters of a record whose phrases are one family.
_FAMILY = 100_000
#: An open question about a key (to < 0), or an answer; prec and pat are the partner's record and place.
_ROWS = "k1 BIGINT, k2 BIGINT, rec BIGINT, at BIGINT, to BIGINT, prec BIGINT, pat BIGINT"


@functools.lru_cache(maxsize=4)
def _powers(mul: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(mul, -1, 1 << 64)
    with np.errstate(over="ignore"):
        up = np.cumprod(np.full(n, np.uint64(mul)), dtype=np.uint64)
        down = np.cumprod(np.full(n, np.uint64(inverse)), dtype=np.uint64)
    return up, down


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(32)
    return h


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def gram_hashes(codes: np.ndarray, k: int, which: int = 0) -> np.ndarray:
    """A 64-bit hash of each k characters in a row; modulo 2^64 by prefix sums, then mixed."""
    n = len(codes)
    if n < k:
        return np.zeros(0, np.uint64)
    size = _PART + 4096
    up, down = _powers(_MUL[which], size if n <= size else n)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((codes + np.uint64(1)) * down[:n], out=sums[1:])
        return _mixed((sums[k:] - sums[:-k]) * up[: n - k + 1])


def _sliding(values: np.ndarray, width: int, of) -> np.ndarray:
    done = 1
    while done < width:
        step = min(done, width - done)
        values = of(values[:-step], values[step:])
        done += step
    return values


def anchors(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
    """Places of `hashes` that are the least of some `width` places within one [start, end) of a text."""
    n = len(hashes)
    if n < width:
        return np.zeros(0, np.int64)
    least = _sliding(hashes, width, np.minimum)
    inside = np.zeros(n + 1, np.int32)
    ok = ends - starts >= width
    np.add.at(inside, starts[ok], 1)
    np.add.at(inside, ends[ok] - width + 1, -1)
    least = np.where(np.cumsum(inside)[: n - width + 1] > 0, least, np.uint64(0))
    edge = np.zeros(width - 1, np.uint64)
    highest = _sliding(np.concatenate([edge, least, edge]), width, np.maximum)
    return np.nonzero((highest == hashes) & (highest > 0))[0]


def _parts(texts: list[str | None], least: int, overlap: int) -> Iterator[list[tuple[int, int, str]]]:
    """Groups of (row, offset, part) of about _PART characters; a long text in overlapping parts."""
    group: list[tuple[int, int, str]] = []
    size = 0
    for i, t in enumerate(texts):
        if t is None or len(t) < least:
            continue
        for at in range(0, max(1, len(t) - overlap), _PART - overlap):
            part = t[at : at + _PART]
            if size and size + len(part) > _PART:
                yield group
                group, size = [], 0
            group.append((i, at, part))
            size += len(part)
    if group:
        yield group


def find_anchors(texts: list[str | None], span: int, phrase: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, place, hash) of each text's anchors."""
    for group in _parts(texts, span, span - 1):
        codes = codes_of("".join(p for _, _, p in group)).astype(np.uint64)
        h = gram_hashes(codes, phrase)
        sizes = np.array([len(p) for _, _, p in group])
        begin = np.cumsum(sizes) - sizes
        at = anchors(h, begin, begin + sizes - phrase + 1, span - phrase + 1)
        which = np.searchsorted(begin, at, "right") - 1
        rows = np.array([i for i, _, _ in group])[which]
        yield rows, at - begin[which] + np.array([o for _, o, _ in group])[which], h[at]


def _rows(n: int, k1=0, k2=0, rec=0, at=0, to=-1, prec=0, pat=0) -> pa.RecordBatch:
    columns = [pa.array(np.broadcast_to(np.asarray(x, np.int64), n)) for x in (k1, k2, rec, at, to, prec, pat)]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _ROWS.split(", ")])


class Keyed:
    """Rows (k1, k2, rec, at) in this order, and which of them have a key of two records."""

    def __init__(self, k1: np.ndarray, k2: np.ndarray, rec: np.ndarray, at: np.ndarray, in_order: bool = False):
        if not in_order:
            order = np.lexsort((at, rec, k2, k1))
            k1, k2, rec, at = k1[order], k2[order], rec[order], at[order]
        self.k1, self.k2, self.rec, self.at = k1, k2, rec, at
        n = len(k1)
        new = np.ones(n, bool)
        new[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
        self.first = np.nonzero(new)[0]  # of each key
        key = np.cumsum(new) - 1
        other = np.zeros(n, bool)
        other[1:] = ~new[1:] & (rec[1:] != rec[:-1])
        second = np.full(len(self.first), -1)  # the key's first row of another record
        found = np.nonzero(other)[0][::-1]
        second[key[found]] = found
        self.head = self.first[key]
        self.shared = second[key] >= 0
        self.partner = np.where(rec != rec[self.head], self.head, second[key])
        # of a key answered here one row: another task that has it in one record only must learn that there are two
        self.passed_on = ~self.shared | new


def _families(rec: np.ndarray, at: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mixed(rec.view(np.uint64) + ((at & 0xFFFFFFFF) // _FAMILY).astype(np.uint64) * np.uint64(_MUL[0])).view(np.int64)


def _routes(rec: np.ndarray, frec: np.ndarray, fat: np.ndarray) -> pa.RecordBatch:
    """Answers of step 1: rec belongs to the family prec; to = 1: the phrase at `at` of rec is the family's."""
    family = _families(frec, fat)
    own = np.unique(np.stack([frec, fat, family]), axis=1)
    member = np.unique(np.stack([rec, family]), axis=1)
    spread = np.concatenate([member[0], own[0]])
    n, m = member.shape[1], own.shape[1]
    return _rows(n + m, k1=spread, rec=spread, at=np.concatenate([np.zeros(n, np.int64), own[1]]), to=np.repeat([0, 1], [n, m]), prec=np.concatenate([member[1], own[2]]))


def _stretches(rec: np.ndarray, at: np.ndarray, prec: np.ndarray, pat: np.ndarray) -> tuple[np.ndarray, ...]:
    """(rec, first place, last place, prec, pat of the first) of runs of consecutive places with consecutive partners."""
    order = np.lexsort((at, at - pat, prec, rec))
    rec, at, prec, pat = rec[order], at[order], prec[order], pat[order]
    new = np.ones(len(rec), bool)
    new[1:] = (rec[1:] != rec[:-1]) | (prec[1:] != prec[:-1]) | (at[1:] - pat[1:] != at[:-1] - pat[:-1]) | (at[1:] > at[:-1] + 1)
    first = np.nonzero(new)[0]
    last = np.append(first[1:], len(rec)) - 1
    return (rec[first], at[first], at[last], prec[first], pat[first]) if len(rec) else (rec, at, at, prec, pat)


def _same_letters(a: str, lo: int, hi: int, b: str, plo: int, span: int) -> list[tuple[int, int]]:
    """[first, last] runs of the windows lo to hi of a that are, letter by letter, those of b from plo on."""
    if a[lo : hi + span] == b[plo : plo + hi - lo + span]:
        return [(lo, hi)]
    same = [i for i in range(lo, hi + 1) if a[i : i + span] == b[plo + i - lo : plo + i - lo + span]]  # two texts of one hash
    return [(i, i) for i in same]


def in_two_records(rows: DataFrame, what: str) -> DataFrame:
    """Answers (rec, at, to, prec, pat): those among the rows, and of the keys that occur in two records.

    what is 'routes' (step 1) or 'windows' (step 3; of windows found here, to is their last place and
    prec, pat the partner they are to be compared with; those compared already have to and no partner).
    Each partition is read in the order of its keys; what is kept is the rows of one key and record.
    """
    sorted_rows = rows.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "rec", "at")

    def found(rec, at, frec, fat, prec, pat) -> pa.RecordBatch:
        if what == "routes":
            return _routes(rec, frec, fat)
        r, lo, hi, p, plo = _stretches(rec, at, prec, pat)
        return _rows(len(r), rec=r, at=lo, to=hi, prec=p, pat=plo)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None  # the last key's rows, all of one record
        proven: tuple | None = None  # the last key, where two records of it were seen, and its first row
        for b in batches:
            columns = [b.column(i).to_numpy() for i in range(7)]
            answer = columns[4] >= 0
            if answer.any():
                yield _rows(int(answer.sum()), *[x[answer] for x in columns])
            k1, k2, rec, at = (x[~answer] for x in columns[:4])
            if proven and len(k1):
                same = (k1 == proven[0]) & (k2 == proven[1])
                if same.any():
                    frec, fat = np.full(int(same.sum()), proven[2]), np.full(int(same.sum()), proven[3])
                    yield found(rec[same], at[same], frec, fat, frec, fat)
                    k1, k2, rec, at = (x[~same] for x in (k1, k2, rec, at))
                if len(k1):
                    proven = None
            if not len(k1):
                continue
            if held is not None:
                k1, k2, rec, at = (np.concatenate([x, y]) for x, y in zip(held, (k1, k2, rec, at)))
                held = None
            k = Keyed(k1, k2, rec, at, True)
            s = k.shared
            if s.any():
                yield found(rec[s], at[s], rec[k.head[s]], at[k.head[s]], rec[k.partner[s]], at[k.partner[s]])
            start = k.first[-1]
            if s[-1]:
                proven = (k1[-1], k2[-1], rec[start], at[start])
            else:
                held = [x[start:].copy() for x in (k1, k2, rec, at)]

    return sorted_rows.mapInArrow(run, _ROWS).select("rec", "at", "to", "prec", "pat")


def shared_windows(records: DataFrame, id_col: str, text_col: str, version: str | None, span: int = SPAN, phrase: int = PHRASE, shard_phrases: int = SHARD_PHRASES) -> DataFrame:
    """(rec, lo, hi): the starts, lo to hi, of windows of `span` characters that another record has too.

    rec is the 64-bit hash of the record's id.
    """
    spark = records.sparkSession
    v = F.col(version) if version else F.lit(0)
    states = records.where(F.col(id_col).isNotNull()).select(F.xxhash64(id_col).alias("rec"), v.alias("v"), F.col(text_col).alias("t"), F.hash(text_col).bitwiseAND(F.lit(0x7FFFFFFF)).cast("bigint").alias("state"))

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = list(find_anchors(b.column(1).to_pylist(), span, phrase))
            if found:
                rows, at, h = (np.concatenate(x) for x in zip(*found))
                ids, state = b.column(0).to_numpy()[rows], b.column(2).to_numpy()[rows]
                h = h.view(np.int64)
                k = Keyed(h, np.zeros(len(h), np.int64), ids, (state << 32) | at)
                s = k.shared
                if s.any():
                    yield _routes(k.rec[s], k.rec[k.head[s]], k.at[k.head[s]])
                on = k.passed_on
                yield _rows(int(on.sum()), k.k1[on], 0, k.rec[on], k.at[on])

    # all states are fingerprinted, as a phrase too many does no harm; documents are the latest ones only
    routes = written(in_two_records(states.where(F.length("t") >= span).select("rec", "t", "state").mapInArrow(phrases, _ROWS), "routes").select("rec", "at", "to", F.col("prec").alias("family")).distinct(), "routes")
    n = routes.agg(F.sum("to")).first()[0]
    if not n:
        return spark.createDataFrame([], "rec BIGINT, lo INT, hi INT")
    shards = max(spark.sparkContext.defaultParallelism, -(-n // shard_phrases))
    shard = F.pmod(F.xxhash64("family"), F.lit(shards)).cast("int")
    named = routes.groupBy("rec").agg(F.collect_set(shard).alias("shards"), F.collect_set(F.when(F.col("to") == 1, F.struct(shard.alias("shard"), "at"))).alias("phrases"))
    recs = routes.select("rec").distinct()
    held = Bitmap.of(recs, "rec", recs.count())

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(held.has(b.column(0).to_numpy())))

    near = states.mapInArrow(routed, states.schema).join(named, "rec")
    newest = Window.partitionBy("rec").orderBy(F.col("v").desc_nulls_last(), F.xxhash64("t").desc())
    near = written(near.withColumn("latest", F.row_number().over(newest) == 1).where(F.length("t") >= span).drop("v"), "routed")
    cut_out = F.filter("phrases", lambda p: F.shiftright(p["at"], 32) == F.col("state"))

    def cut_phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(p["shard"], t[(p["at"] & 0xFFFFFFFF) : (p["at"] & 0xFFFFFFFF) + phrase]) for t, places in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for p in places]
            shard_of, texts = zip(*rows) if rows else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(shard_of, pa.int32()), pa.array(texts, pa.string())], names=["shard", "t"])

    patterns = near.select("t", cut_out.alias("ps")).where(F.size("ps") > 0).mapInArrow(cut_phrases, "shard INT, t STRING")
    patterns = patterns.select("shard", F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("rec"), "t")
    docs = near.where("latest").select(F.explode("shards").alias("shard"), F.lit(1).alias("kind"), "rec", "t")
    stream = patterns.unionByName(docs).repartition(shards, "shard").sortWithinPartitions("shard", "kind")
    answers = in_two_records(stream.mapInArrow(lambda batches: _windows(batches, span, phrase), _ROWS), "windows")
    answers = written(answers, "windows")
    texts = near.where("latest").select("rec", "t")
    # windows answered one by one become stretches again before any text is joined
    along = Window.partitionBy("rec", "prec", "shift").orderBy("at")
    apart = answers.where("pat >= 0").withColumn("shift", F.col("at") - F.col("pat"))
    apart = apart.withColumn("new", F.when(F.col("at") <= F.lag("to").over(along) + 1, 0).otherwise(1)).withColumn("run", F.sum("new").over(along))
    stretches = apart.groupBy("rec", "prec", "shift", "run").agg(F.min("at").alias("at"), F.max("to").alias("to")).withColumn("pat", F.col("at") - F.col("shift"))
    open_ones = stretches.join(texts, "rec").withColumnRenamed("t", "a").join(texts.select(F.col("rec").alias("prec"), F.col("t").alias("b")), "prec")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(r["rec"], lo, hi) for r in b.to_pylist() for lo, hi in _same_letters(r["a"], r["at"], r["to"], r["b"], r["pat"], span)]
            rec, lo, hi = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(rec, pa.int64()), pa.array(lo, pa.int32()), pa.array(hi, pa.int32())], names=["rec", "lo", "hi"])

    done = answers.where("pat < 0").select("rec", F.col("at").cast("int").alias("lo"), F.col("to").cast("int").alias("hi"))
    return done.unionByName(open_ones.select("rec", "at", "to", "pat", "a", "b").mapInArrow(compared, "rec BIGINT, lo INT, hi INT"))


def _windows(batches: Iterator[pa.RecordBatch], span: int, phrase: int) -> Iterator[pa.RecordBatch]:
    """Rows (shard, kind, rec, t), the phrases of a shard before its documents, to rows of _ROWS."""
    import ahocorasick

    shard, automaton, ready = None, None, False
    for b in batches:
        found, texts = [], {}
        for s, kind, rec, t in zip(*[c.to_pylist() for c in b.columns]):
            if s != shard:
                shard, automaton, ready = s, ahocorasick.Automaton(), False
            if kind == 0:
                automaton.add_word(t, True)
                continue
            if not len(automaton):
                continue
            if not ready:
                automaton.make_automaton()
                ready = True
            ends = np.fromiter((e for e, _ in automaton.iter(t)), dtype=np.int64)
            if len(ends):
                texts[rec] = t
                found += _around(t, ends - phrase + 1, rec, span, phrase)
        if not found:
            continue
        k = Keyed(*[np.concatenate(x) for x in zip(*found)])
        s = k.shared
        if s.any():
            same = [(r, x, y) for r, lo, hi, p, plo in zip(*[x.tolist() for x in _stretches(k.rec[s], k.at[s], k.rec[k.partner[s]], k.at[k.partner[s]])]) for x, y in _same_letters(texts[r], lo, hi, texts[p], plo, span)]
            if same:
                r, lo, hi = (np.array(x, dtype=np.int64) for x in zip(*same))
                yield _rows(len(r), k1=r ^ (lo * 0x9E3779B1), rec=r, at=lo, to=hi, pat=-1)
        on = k.passed_on
        yield _rows(int(on.sum()), k.k1[on], k.k2[on], k.rec[on], k.at[on])


def _around(t: str, at: np.ndarray, rec: int, span: int, phrase: int) -> list[tuple]:
    """(k1, k2, rec, at) of the windows of t that hold one of the phrases at `at`, in runs."""
    first, last = np.maximum(at - (span - phrase), 0), np.minimum(at, len(t) - span)
    ok = first <= last
    mark = np.zeros(len(t) + 1, np.int32)
    np.add.at(mark, first[ok], 1)
    np.add.at(mark, last[ok] + 1, -1)
    inside = np.diff(np.concatenate([[0], (np.cumsum(mark) > 0).astype(np.int8), [0]]))
    out = []
    for lo, hi in zip(np.nonzero(inside > 0)[0].tolist(), np.nonzero(inside < 0)[0].tolist()):
        for x in range(lo, hi, _PART):
            y = min(hi, x + _PART)
            codes = codes_of(t[x : y - 1 + span]).astype(np.uint64)
            out.append((gram_hashes(codes, span).view(np.int64), gram_hashes(codes, span, 1).view(np.int64), np.full(y - x, rec, np.int64), np.arange(x, y)))
    return out


def shared_spans(records: DataFrame, id_col: str = "chunk_id", text_col: str = "text", version: str | None = "ingested_at", span: int = SPAN, phrase: int = PHRASE) -> DataFrame:
    """(id, span_start, span_end): the maximal runs of shared characters of each record's latest state.

    A character is shared if it lies in `span` characters that another record's text has too. Null,
    empty and shorter texts have no run, nor have records with a null id; rows of one id count as one
    record, of which the greatest version is taken (of
    equal ones the text with the greatest hash); other columns are ignored.
    """
    hits = shared_windows(records, id_col, text_col, version, span, phrase)
    w = Window.partitionBy("rec").orderBy("lo", "hi")
    before = F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    runs = hits.withColumn("new", F.when(before.isNull() | (F.col("lo") > before + span), 1).otherwise(0)).withColumn("run", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    spans = runs.groupBy("rec", "run").agg(F.min("lo").alias("span_start"), (F.max("hi") + span).cast("int").alias("span_end"))
    names = records.where(F.col(id_col).isNotNull()).select(F.xxhash64(id_col).alias("rec"), F.col(id_col)).distinct()
    return spans.join(names, "rec").select(id_col, "span_start", "span_end")


def shared_shares(records: DataFrame, id_col: str = "chunk_id", text_col: str = "text", version: str | None = "ingested_at", span: int = SPAN) -> DataFrame:
    """(id, n_chars, n_shared, share) of every record: how much of it stands elsewhere too."""
    spans = shared_spans(records, id_col, text_col, version, span).groupBy(id_col).agg(F.sum(F.col("span_end") - F.col("span_start")).alias("n_shared"))
    v = F.col(version) if version else F.lit(0)
    sizes = records.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max(F.struct(v.alias("v"), F.xxhash64(text_col).alias("h"), F.length(text_col).alias("n"))).alias("s")).select(id_col, F.coalesce("s.n", F.lit(0)).alias("n_chars"))
    n = F.coalesce(F.col("n_shared"), F.lit(0))
    return sizes.join(spans, id_col, "left").select(id_col, "n_chars", n.alias("n_shared"), F.coalesce(F.try_divide(n, F.col("n_chars")), F.lit(0.0)).alias("share"))
