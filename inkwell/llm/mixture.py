"""Problem 7: a mixture of sources at target shares of tokens, by cube-method balanced sampling.

Each document of a source gets the same expected number of copies, r = tokens wanted / tokens there,
at most max_repeats. floor(r) copies are sure; the fraction of r is an inclusion probability. The
flight of the cube method moves these probabilities: of three open documents of a source, the vector
that keeps both their expected tokens and their expected number is the cross product of the two
constraint rows; a random step along it, up or down so that expectations hold, ends at a 0 or a 1 and
decides a document. A task does so with its own rows in one pass and leaves at most two open documents
of each source; these few fly together, and the last two of a source land where its total comes nearest.
Two long documents may still be far from it. So a bounded number of ordinary documents of each source,
drawn by hash, flies last: their probabilities first take up what the landing of the others left.

Which documents are drawn depends on how the rows lie in the tasks; shares, caps and expectations don't.
"""

from __future__ import annotations

import itertools
import random
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.tokenizing import TOKENIZER_DIR, encoder
from inkwell.session import cut

_EPS = 1e-9
#: The sources and their shares are a configuration, which the driver knows; up to so many names are broadcast.
MOST_BROADCAST = 100_000
#: Documents of a source that fly last: about so many, of those no longer than LAST_LENGTH times its mean.
LAST_UNITS = 400
LAST_LENGTH = 3


def source_rates(targets: dict[str, tuple[float, int]], tokens: dict[str, int], total: float | None = None, give_up: float = 0.05) -> dict[str, float]:
    """Expected copies of a document, by source.

    Without a total, it is the largest at which all sources reach their share but for the most starved
    ones, whose shares together are at most give_up; sources without tokens are among those whatever
    their share. A starved source gives all it may, and the others share what it leaves open in
    proportion to their shares.
    """
    supply = {s: tokens.get(s, 0) * max(0, reps or 0) for s, (_, reps) in targets.items()}
    live = sorted((s for s, (w, _) in targets.items() if supply[s] > 0 and (w or 0) > 0), key=lambda s: (supply[s] / targets[s][0], s))
    if not live:
        return {}
    if total is None:
        spare, k = give_up - sum(w or 0 for s, (w, _) in targets.items() if supply[s] <= 0), 0
        while k < len(live) - 1 and targets[live[k]][0] <= spare + 1e-12:
            spare -= targets[live[k]][0]
            k += 1
        starved, rest = live[:k], live[k:]
        # with the starved ones used up, the others' total is that of the first to be exhausted
        weight = sum(targets[s][0] for s in rest)
        left = min(supply[s] * weight / targets[s][0] for s in rest)
        total = left + sum(supply[s] for s in starved)
    want: dict[str, float] = {}
    open_ones, left = list(live), total
    while open_ones:
        weight = sum(targets[s][0] for s in open_ones)
        full = [s for s in open_ones if left * targets[s][0] / weight >= supply[s]]
        if not full:
            want |= {s: left * targets[s][0] / weight for s in open_ones}
            break
        for s in full:
            want[s] = supply[s]
        left -= sum(supply[s] for s in full)
        open_ones = [s for s in open_ones if s not in want]
        if left <= 0:
            break
    return {s: min(want[s] / tokens[s], targets[s][1]) for s in want}


def step(units: list[list], rng: random.Random) -> None:
    """Moves the probabilities of three units [p, tokens, ...] in place; at least one becomes 0 or 1.

    The step keeps sum(p) and sum(p * tokens). Units of equal tokens make the two constraints the same
    row; then two of them trade, which keeps both sums too.
    """
    a, b, c = units[0][1], units[1][1], units[2][1]
    v = (b - c, c - a, a - b)
    if v == (0, 0, 0):
        v = (1, -1, 0)
    up = min(((1 - u[0]) / x if x > 0 else u[0] / -x) for u, x in zip(units, v) if x)
    down = min((u[0] / x if x > 0 else (1 - u[0]) / -x) for u, x in zip(units, v) if x)
    move = up if rng.random() * (up + down) < down else -down
    for u, x in zip(units, v):
        u[0] = min(1.0, max(0.0, u[0] + move * x))


def flight(units: Iterator[list], rng: random.Random) -> Iterator[list]:
    """Yields each unit [p, tokens, ...] once, p being 0 or 1 for all but the last two at most."""
    held: list[list] = []
    for u in units:
        held.append(u)
        if len(held) < 3:
            continue
        step(held, rng)
        still = []
        for x in held:
            if x[0] < _EPS or x[0] > 1 - _EPS:
                x[0] = float(round(x[0]))
                yield x
            else:
                still.append(x)
        held = still
    yield from held


def landing(units: list[list], wanted: float) -> None:
    """Decides open units so that their tokens together come nearest to wanted; ties take fewer."""
    best = min(itertools.product((0.0, 1.0), repeat=len(units)), key=lambda z: (abs(sum(p * u[1] for p, u in zip(z, units)) - wanted), sum(z), z))
    for u, p in zip(units, best):
        u[0] = p


def settle(units: list[list], wanted: float, rng: random.Random) -> None:
    """Flight and landing of all units, in place."""
    list(flight(iter(units), rng))
    sure = [u for u in units if not _EPS < u[0] < 1 - _EPS]
    landing([u for u in units if _EPS < u[0] < 1 - _EPS], wanted - sum(u[0] * u[1] for u in sure))


def count_tokens(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, folder: str) -> DataFrame:
    """(id, source, tokens); 0 for null and empty texts."""
    data = docs.select(F.col(id_col).alias("id"), F.col("source"), F.col(text_col).alias("t"))
    kind = data.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = encoder(tokenizer, folder).count
        for b in batches:
            n = pa.array([count(t) for t in b.column(2).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), n], names=["id", "source", "tokens"])

    return data.mapInArrow(run, f"id {kind}, source STRING, tokens BIGINT")


def mix(docs: DataFrame, mix_targets: DataFrame, total_tokens: float | None = None, tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", give_up: float = 0.0) -> DataFrame:
    """(id, source, tokens, copies) of every document of a listed source that holds a token.

    copies is 0 to max_repeats. Documents of unlisted or null sources and those without tokens (null,
    empty) are left out. A listed source without documents reaches 0. Repeated rows are documents of
    their own. No documents or no targets give no rows. A source listed twice is an error.
    """
    spark = docs.sparkSession
    listed = mix_targets.where("source IS NOT NULL").select("source", "target_share", "max_repeats").collect()
    targets = {r[0]: (float(r[1] or 0), int(r[2] or 0)) for r in listed}
    if len(targets) < len(listed):
        raise ValueError("a source is listed twice")
    names = spark.createDataFrame([(s,) for s in targets], "source STRING")
    # with the names broadcast texts stay where they are read, however large a source is
    mine = docs.join(F.broadcast(names) if len(targets) <= MOST_BROADCAST else names, "source", "left_semi") if targets else docs.where("false")
    counted = cut(count_tokens(mine, id_col, text_col, tokenizer, folder).where("tokens > 0"))
    sizes = {r[0]: (int(r[1]), int(r[2])) for r in counted.groupBy("source").agg(F.sum("tokens"), F.count(F.lit(1))).collect()}
    sums = {s: n for s, (n, _) in sizes.items()}
    rates = source_rates(targets, sums, total_tokens, give_up)
    kind = counted.schema["id"].dataType.simpleString()
    out = f"id {kind}, source STRING, tokens BIGINT, p DOUBLE, open BOOLEAN, last BOOLEAN, base INT"

    columns = ["id", "source", "tokens", "p", "open", "last", "base"]

    def rows_of(units: list[list], key: pa.DataType, is_open: bool, is_last: bool = False) -> pa.RecordBatch:
        """Units [p, tokens, id, source, base] as rows."""
        n = len(units)
        arrays = [pa.array([u[2] for u in units], key), pa.array([u[3] for u in units], pa.string()), pa.array([u[1] for u in units], pa.int64()), pa.array([float(u[0]) for u in units], pa.float64()),
                  pa.array([is_open] * n, pa.bool_()), pa.array([is_last] * n, pa.bool_()), pa.array([u[4] for u in units], pa.int32())]
        return pa.RecordBatch.from_arrays(arrays, names=columns)

    def fly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        rngs: dict[str, random.Random] = {}
        done: list[list] = []
        last: list[list] = []
        key_type = None
        for b in batches:
            key_type = b.schema.field(0).type
            for key, source, n in zip(*[b.column(i).to_pylist() for i in range(3)]):
                rate = rates.get(source, 0.0)
                base = int(rate + _EPS)
                p = max(0.0, rate - base)
                total, count = sizes[source]
                if p < _EPS:
                    done.append([0.0, n, key, source, base])
                elif n <= LAST_LENGTH * total / count and zlib.crc32(f"{seed}/{key}".encode()) < (1 << 32) * LAST_UNITS / count:
                    last.append([p, n, key, source, base])
                else:
                    rng = rngs.setdefault(source, random.Random(f"{seed}/{source}/{key}"))
                    mine = held.setdefault(source, [])
                    mine.append([p, n, key, source, base])
                    if len(mine) == 3:
                        decided = list(flight(iter(mine), rng))
                        held[source] = [u for u in decided if _EPS < u[0] < 1 - _EPS]
                        done += [u for u in decided if not _EPS < u[0] < 1 - _EPS]
            if len(done) >= 20_000:
                yield rows_of(done, key_type, False)
                done = []
        if key_type is not None:
            yield rows_of(done, key_type, False)
            yield rows_of([u for x in held.values() for u in x], key_type, True)
            yield rows_of(last, key_type, True, True)

    def land(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: (r["last"], str(r["id"]), r["tokens"]))
        rng = random.Random(f"{seed}/{rows[0]['source']}")
        units = [[r["p"], r["tokens"], r["id"], r["source"], r["base"]] for r in rows]
        wanted = sum(u[0] * u[1] for u in units)
        first, last = ([u for u, r in zip(units, rows) if r["last"] is is_last] for is_last in (False, True))
        settle(first, sum(u[0] * u[1] for u in first), rng)
        missing = wanted - sum(u[0] * u[1] for u in first)
        if first and last:
            shift = (missing - sum(u[0] * u[1] for u in last)) / sum(u[1] for u in last)
            for u in last:
                u[0] = min(1.0, max(0.0, u[0] + shift))
        settle(last, missing, rng)
        return pa.Table.from_batches([rows_of(first + last, group.schema.field("id").type, False)])

    flown = cut(counted.mapInArrow(fly, out))
    landed = flown.where("open").groupBy("source").applyInArrow(land, out)
    return flown.where("NOT open").unionByName(landed).select(F.col("id").alias(id_col), "source", "tokens", (F.col("base") + F.round("p").cast("int")).alias("copies"))


def mix_report(mixed: DataFrame, mix_targets: DataFrame) -> DataFrame:
    """Per listed source: its target, the share reached, and documents, copies and tokens used.

    A source without documents has 0; if nothing was mixed, the reached share is null.
    """
    used = mixed.groupBy("source").agg(
        F.count_if(F.col("copies") > 0).alias("docs_used"), F.sum("copies").alias("copies"), F.max("copies").alias("most_copies"), F.sum(F.col("copies") * F.col("tokens")).alias("tokens_used"))
    whole = used.agg(F.sum("tokens_used").alias("all_tokens"))
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("docs_used", "copies", "most_copies", "tokens_used")}
    joined = mix_targets.select("source", "target_share", "max_repeats").join(used, "source", "left").withColumns(zero)
    return joined.crossJoin(whole).select("source", "target_share", F.try_divide(F.col("tokens_used"), F.col("all_tokens")).alias("reached_share"), "docs_used", "copies", "most_copies", "max_repeats", "tokens_used")
