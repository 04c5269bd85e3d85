"""Exact search for the highest inner products by an M-tree of paged metric nodes.

The root level are cells round up to MOST_CELLS pivots; a cell's rows lie in bins of about BIN_ROWS, each a subtree of
pages that one task builds and one row of the index holds. A page has a routing object, a covering radius and the
distance of its routing object to its parent's; a row of a leaf has its distance to the leaf's routing object. For one
query `best_first` takes the page with the highest bound first. The triangle inequality bounds an entry from the two stored distances alone
before anything is computed for it, and what is left is bounded by its covering radius; pages below the k-th score so far
are never opened. Subtrees lie in lanes of LANE values at most, and blocks of near queries stream past those whose bounds
reach one of them: `best_of_block` opens a page for the queries of a block that its bounds let in, by the floors that their
own cells gave and what was found since, and scores the rows of neighbouring leaves in one product of matrices.

For an object o, a radius r round it and the highest squared norm s of what lies there, a query q with d = |q - o| has no
product above (|q|^2 + s - max(0, d - r)^2) / 2, nor above <q, o> + |q| r. Bounds are raised by SLACK for rounding; the
scores themselves are exact integers.

Input: rows (vec_id long, v array<bigint>), vectors without nulls (see vectors.whole). Rows with a null id take no part,
as a result could not name them. Equal rows count once; rows that share an id but no vector count each, as candidates and
as queries. A query never meets rows of its own id. Empty vectors have product 0 with all. No rows give no results.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardstone.llm import vectors
from wardstone.llm.lanes import met
from wardstone.llm.storage import stored

#: Entries of a page; children of an inner page.
PAGE, FANOUT = 128, 16
#: Rows for one cell on average, rows of one subtree, and cells at most (their pivots go to every task).
CELL_ROWS, BIN_ROWS, MOST_CELLS = 2048, 8192, 4096
#: Queries that one subtree answers at a time, values of the subtrees of a lane, lanes for each core at least (where there
#: are as many subtrees), rows of leaves that are scored at once, and hits that are gathered before the best are kept.
QUERY_BLOCK, LANE, LANES_EACH, SLAB, HITS = 2048, 1 << 23, 4, 1024, 1 << 20
SLACK = 1e-9

_TREE = (
    "lane int, cell long, bin long, ids array<long>, tree_values binary, row_apart array<double>, low array<long>, high array<long>, "
    "leaf array<boolean>, routing array<long>, radius array<double>, apart array<double>, reach array<double>, cell_radius double"
)
_BLOCK = "block long, asks array<long>, query_ids array<long>, homes array<long>, query_values binary"


@dataclass
class Tree:
    """A subtree. Rows stand in the order of the leaves, pages by level, so children of a page are neighbours."""

    ids: np.ndarray
    values: np.ndarray
    #: Of each row: distance to the routing object of its leaf.
    row_apart: np.ndarray
    #: Of each page: its rows, or its children.
    low: np.ndarray
    high: np.ndarray
    leaf: np.ndarray
    #: Of each page: the row that is its routing object, covering radius, distance to the parent's routing object, highest squared norm.
    routing: np.ndarray
    radius: np.ndarray
    apart: np.ndarray
    reach: np.ndarray


def _apart(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    difference = values - at
    return np.sqrt(vectors.squares(difference))


def _parts(values: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """Rows dealt to pivots that lie far from each other; where one pivot draws nearly all, equal rings round it."""
    n = min(FANOUT, -(-len(rows) // PAGE))
    own = values[rows]
    chosen, gap = [0], _apart(own, own[0])
    while len(chosen) < n and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, _apart(own, own[chosen[-1]]))
    at, far = vectors.nearest(own, own[chosen])
    sizes = np.bincount(at, minlength=len(chosen))
    if sizes.max() > 0.75 * len(rows):
        return np.array_split(rows[np.lexsort((rows, far, at))], n)
    return [rows[at == i] for i in np.flatnonzero(sizes)]


def build(ids: np.ndarray, values: np.ndarray) -> Tree:
    """The subtree of at least one row."""
    norms = vectors.squares(values)
    order, row_apart, pages = [], [], []
    waiting = [(np.arange(len(ids)), None)]
    placed = 0
    for rows, parent in waiting:  # grows while it is read
        centre = rows[_apart(values[rows], values[rows].mean(0)).argmin()]
        far = _apart(values[rows], values[centre])
        page = {"routing": centre, "radius": far.max(), "reach": norms[rows].max(), "apart": 0.0 if parent is None else float(np.sqrt(((values[centre] - values[parent]) ** 2).sum()))}
        if len(rows) <= PAGE:
            page |= {"leaf": True, "low": placed, "high": placed + len(rows)}
            order.append(rows)
            row_apart.append(far)
            placed += len(rows)
        else:
            parts = _parts(values, rows)
            page |= {"leaf": False, "low": len(waiting), "high": len(waiting) + len(parts)}
            waiting += [(part, centre) for part in parts]
        pages.append(page)
    order = np.concatenate(order)
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    of = {name: np.array([page[name] for page in pages]) for name in pages[0]}
    return Tree(ids[order], values[order], np.concatenate(row_apart), of["low"], of["high"], of["leaf"], place[of["routing"]], of["radius"], of["apart"], of["reach"])


def _limit(square: float, reach: np.ndarray, gap: np.ndarray) -> np.ndarray:
    """The highest product of a query of this squared norm with vectors of at most `reach` that are `gap` apart or more."""
    return (square + reach - np.maximum(0.0, gap) ** 2) / 2 + SLACK * (square + reach) + SLACK


def best_first(tree: Tree, own: int, query: np.ndarray, k: int, floor: float = -np.inf) -> tuple[list[tuple[int, int]], int]:
    """The k best (score, id) of at least `floor`, and how many products were computed."""
    square = float(query @ query)
    norm, reckoned = square**0.5, 1
    best: list[tuple[int, int]] = []  # a heap of (score, -id)
    least = floor
    waiting = [(-np.inf, 0, float(np.sqrt(((query - tree.values[tree.routing[0]]) ** 2).sum())))]
    while waiting:
        limit, page, far = heapq.heappop(waiting)
        if -limit < least:
            break
        low, high = int(tree.low[page]), int(tree.high[page])
        if tree.leaf[page]:
            # a gap of more than `most` between the two stored distances bounds the product below `least`
            most = max(0.0, (square + float(tree.reach[page])) * (1 + SLACK) + SLACK - 2 * least) ** 0.5 + SLACK * far
            near = np.abs(tree.row_apart[low:high] - far) <= most
            n = int(np.count_nonzero(near))
            rows = slice(low, high) if n == high - low else low + np.flatnonzero(near)
            scores, ids = tree.values[rows] @ query, tree.ids[rows]
            reckoned += n
            for at in np.flatnonzero(scores >= least).tolist():
                found, vec_id = int(scores[at]), int(ids[at])
                if vec_id == own:
                    continue
                if len(best) < k:
                    heapq.heappush(best, (found, -vec_id))
                else:
                    heapq.heappushpop(best, (found, -vec_id))
                if len(best) == k:
                    least = max(floor, best[0][0])
        else:
            gap = np.abs(far - tree.apart[low:high]) - tree.radius[low:high] - SLACK * far
            children = low + np.flatnonzero(_limit(square, tree.reach[low:high], gap) >= least)
            objects, radius = tree.values[tree.routing[children]], tree.radius[children]
            products = objects @ query
            reckoned += len(children)
            apart = np.sqrt(np.maximum(0.0, square + vectors.squares(objects) - 2 * products))
            limits = np.minimum(_limit(square, tree.reach[children], apart - radius - SLACK * apart), products + norm * radius * (1 + SLACK) + SLACK * (1 + square))
            for more in zip((-limits).tolist(), children.tolist(), apart.tolist()):
                if -more[0] >= least:
                    heapq.heappush(waiting, more)
    return [(score, -less) for score, less in best], reckoned


class Asked:
    """A block of queries and their best rows so far."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, k: int, floors: np.ndarray):
        self.ids, self.values, self.k, self.floors = ids, values, k, floors
        self.square, self.least = vectors.squares(values), floors.copy()
        self.single, self.waiting = values.astype(np.float32), 0
        self.at, self.vec_id, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.hits: list[tuple] = []

    def add(self, at: np.ndarray, vec_id: np.ndarray, score: np.ndarray) -> None:
        self.hits.append((at, vec_id, score.astype(np.int64)))
        self.waiting += len(at)
        if self.waiting >= HITS:
            self.fold()

    def fold(self) -> None:
        """Keeps the best k of each query."""
        at, vec_id, score = (np.concatenate([own, *more]) for own, more in zip((self.at, self.vec_id, self.score), zip(*self.hits) if self.hits else ([],) * 3))
        other = np.flatnonzero(vec_id != self.ids[at])
        order = other[np.lexsort((vec_id[other], -score[other], at[other]))]
        at = at[order]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        order, last = order[rank < self.k], rank == self.k - 1
        self.at, self.vec_id, self.score = at[rank < self.k], vec_id[order], score[order]
        of, kth = at[last], self.score[np.flatnonzero(rank[rank < self.k] == self.k - 1)]
        self.least[of] = np.maximum(self.floors[of], kth)
        self.hits, self.waiting = [], 0


def _near_rows(tree: Tree, page: int, square: np.ndarray, least: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Rows of a leaf that the two stored distances let in for any of the queries: its place in the tree, from and to."""
    low, high = int(tree.low[page]), int(tree.high[page])
    most = np.sqrt(np.maximum(0.0, (square + float(tree.reach[page])) * (1 + SLACK) + SLACK - 2 * least)) + SLACK * far
    own = tree.row_apart[low:high]
    return low + np.flatnonzero((own >= (far - most).min()) & (own <= (far + most).max()))


def best_of_block(tree: Tree, asked: Asked, own: np.ndarray | None = None, single: np.ndarray | None = None) -> int:
    """Adds the rows of a subtree to the best of a block's queries, or of those at the places `own`; how many products were
    computed. single: the tree's values in single precision, where products are exact in it."""
    single = tree.values if single is None else single
    queries = asked.single if single.dtype == np.float32 else asked.values
    own = np.arange(len(asked.ids)) if own is None else own
    if not len(own):
        return 0
    products = asked.values[own] @ tree.values[tree.routing[0]]
    far = np.sqrt(np.maximum(0.0, asked.square[own] + vectors.squares(tree.values[tree.routing[:1]])[0] - 2 * products))
    waiting, leaves, reckoned = [(0, own, far)], [], len(own)
    limit = _limit(asked.square[own], tree.reach[0], far - tree.radius[0] - SLACK * far)
    if not (limit >= asked.least[own]).any():
        return reckoned
    while waiting:
        page, at, far = waiting.pop()
        low, high = int(tree.low[page]), int(tree.high[page])
        square, least = asked.square[at], asked.least[at]
        if tree.leaf[page]:
            rows = _near_rows(tree, page, square, least, far)
            if len(rows):
                leaves.append((rows, at))
            continue
        gap = np.abs(far[:, None] - tree.apart[low:high]) - tree.radius[low:high] - SLACK * far[:, None]
        opened = _limit(square[:, None], tree.reach[low:high], gap) >= least[:, None]
        children, rows = low + np.flatnonzero(opened.any(0)), np.flatnonzero(opened.any(1))
        if not len(children):
            continue
        at, square, least, opened = at[rows], square[rows, None], least[rows, None], opened[np.ix_(rows, children - low)]
        objects, radius = tree.values[tree.routing[children]], tree.radius[children]
        products = asked.values[at] @ objects.T
        reckoned += products.size
        apart = np.sqrt(np.maximum(0.0, square + vectors.squares(objects) - 2 * products))
        limits = np.minimum(_limit(square, tree.reach[children], apart - radius - SLACK * apart), products + np.sqrt(square) * radius * (1 + SLACK) + SLACK * (1 + square))
        opened &= limits >= least
        for i, child in enumerate(children.tolist()):
            into = np.flatnonzero(opened[:, i])
            if len(into):
                waiting.append((child, at[into], apart[into, i]))
    # neighbouring leaves that most queries opened are scored together; whom a bound kept out has no hit in them
    slabs: list[tuple[list, np.ndarray]] = []
    for rows, at in sorted(leaves, key=lambda leaf: int(leaf[0][0])):
        at = own if 2 * len(at) >= len(own) else at
        if slabs and at is own and slabs[-1][1] is own and sum(map(len, slabs[-1][0])) + len(rows) <= SLAB:
            slabs[-1][0].append(rows)
        else:
            slabs.append(([rows], at))
    for parts, at in slabs:
        rows = np.concatenate(parts)
        begin, end = int(rows[0]), int(rows[-1]) + 1
        held = single[begin:end] if end - begin == len(rows) else single[rows]
        scores = (queries if len(at) == len(queries) else queries[at]) @ held.T
        reckoned += scores.size
        hit = np.flatnonzero(scores >= asked.least[at].astype(scores.dtype)[:, None])
        if len(hit):
            asked.add(at[hit // len(rows)], tree.ids[rows[hit % len(rows)]], scores.ravel()[hit])
    asked.fold()
    return reckoned


@dataclass
class Index:
    """Subtrees, a row each, the cells they lie in (at most MOST_CELLS), and the lanes that cells begin in."""

    trees: DataFrame
    rows: DataFrame
    shape: vectors.Shape
    pivots: np.ndarray
    radius: np.ndarray
    reach: np.ndarray
    bins: np.ndarray
    lanes: int
    first: np.ndarray
    step: np.ndarray

    def lanes_of(self, cell: int) -> range:
        """The lanes that hold the bins of a cell."""
        return range(_lane(self.first[cell], self.step[cell], 0), _lane(self.first[cell], self.step[cell], self.bins[cell] - 1) + 1)


def _lane(first: float, step: float, bin: int) -> int:
    return int(first + bin * step)


def _chain(pivots: np.ndarray) -> np.ndarray:
    """The pivots in an order in which each is followed by the nearest of those left."""
    left, at, order, own = np.ones(len(pivots), dtype=bool), 0, [], vectors.squares(pivots)
    for _ in range(len(pivots)):
        order.append(at)
        left[at] = False
        at = int(np.where(left, own - 2 * (pivots @ pivots[at]), np.inf).argmin())
    return np.array(order, dtype=np.int64)


def _subtree(shape: vectors.Shape, first_lane: np.ndarray, step: np.ndarray):
    def of(key: tuple, table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids = table.column("vec_id").to_numpy()
        values = np.concatenate([vectors.matrix(chunk, shape.width) for chunk in table.column("v").chunks])
        first = np.unique(np.column_stack([ids, values.astype(np.int64)]), axis=0, return_index=True)[1]
        tree = build(ids[first], values[first])
        cell, bin = key[0].as_py(), key[1].as_py()
        one = {name: [getattr(tree, name).tolist()] for name in ("ids", "row_apart", "low", "high", "leaf", "routing", "radius", "apart", "reach")}
        one |= {"lane": [_lane(first_lane[cell], step[cell], bin)], "cell": [cell], "bin": [bin], "tree_values": [tree.values.astype(shape.kind()).tobytes()], "cell_radius": [float(np.max(table.column("far").to_numpy()))]}
        names = [c.split()[0] for c in _TREE.split(", ")]
        return pa.table({name: pa.array(one[name], pa.int32()) if name == "lane" else one[name] for name in names})

    return of


def index(rows: DataFrame, cell_rows: int = CELL_ROWS, bin_rows: int = BIN_ROWS) -> Index:
    """The M-tree of all rows (vec_id, v); the cells' pivots are a bounded sample of them."""
    rows = rows.where(F.col("vec_id").isNotNull()).select("vec_id", "v")
    shape = vectors.shape(rows)
    pivots = vectors.pivots(rows, min(MOST_CELLS, -(-shape.rows // cell_rows)), shape.width)
    if not len(pivots):
        pivots = np.zeros((1, shape.width))
    dealt = stored(vectors.assigned(rows, pivots, shape.width))
    sizes = dealt.groupBy("cell").agg(F.count("*").alias("rows"), F.ceil(F.count("*") / bin_rows).alias("bins"))
    count, bins = np.zeros(len(pivots), dtype=np.int64), np.zeros(len(pivots), dtype=np.int64)
    for row in sizes.toLocalIterator():  # at most MOST_CELLS rows
        count[row["cell"]], bins[row["cell"]] = row["rows"], row["bins"]
    # cells that are near each other share a lane; one of several bins may reach over more than one
    cores = rows.sparkSession.sparkContext.defaultParallelism
    lanes = max(1, -(-int(count.sum()) * shape.width // LANE), min(LANES_EACH * cores, int(bins.sum())))
    order = _chain(pivots)
    before = np.cumsum(count[order]) - count[order]
    first = np.zeros(len(pivots))
    first[order] = before * lanes / max(1, count.sum())
    step = count * lanes / max(1, count.sum()) / np.maximum(1, bins)
    bin = F.pmod(F.xxhash64("vec_id"), F.col("bins")).alias("bin")
    trees = stored(
        dealt.join(F.broadcast(sizes.select("cell", "bins")), "cell").select("cell", bin, "vec_id", "v", "far")  # at most MOST_CELLS rows
        .groupBy("cell", "bin").applyInArrow(_subtree(shape, first, step), _TREE)
    )
    radius, reach = np.zeros(len(pivots)), np.full(len(pivots), -1.0)
    for row in trees.groupBy("cell").agg(F.max("cell_radius").alias("radius"), F.max(F.array_max("reach")).alias("reach")).toLocalIterator():
        radius[row["cell"]], reach[row["cell"]] = row["radius"], row["reach"]
    return Index(trees, dealt, shape, pivots, radius, reach, bins, lanes, first, step)


def _values(column: pa.Array, at: int, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(column[at].as_buffer(), dtype=kind).astype(np.float64).reshape(-1, width)


def _packed_queries(queries: DataFrame, held: np.ndarray, pivots: np.ndarray, shape: vectors.Shape) -> DataFrame:
    """Queries (ask, vec_id, v) in blocks of near ones; `homes` are the cells, with rows in them, that they are nearest to."""
    near = vectors.assigned(queries, pivots[held], shape.width)
    tasks = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = np.zeros(len(pivots), dtype=np.int64)
    place[_chain(pivots)] = np.arange(len(pivots))
    kind = shape.kind()

    def homed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            home = held[batch.column("cell").to_numpy()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("ask", "vec_id", "v")), pa.array(home), pa.array(place[home])], ["ask", "vec_id", "v", "home", "place"])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, QUERY_BLOCK):
                own = batch.slice(at, QUERY_BLOCK)
                lists = [pa.array([own.column(c).to_numpy()]) for c in ("ask", "vec_id", "home")]
                values = pa.array([vectors.matrix(own.column("v"), shape.width).astype(kind).tobytes()], pa.binary())
                yield pa.RecordBatch.from_arrays([own.column("ask").slice(0, 1), *lists, values], ["block", "asks", "query_ids", "homes", "query_values"])

    homes = near.mapInArrow(homed, "ask long, vec_id long, v array<bigint>, home long, place long")
    lain = homes.repartitionByRange(tasks, "place", "ask").sortWithinPartitions("place", "ask")
    return stored(lain.mapInArrow(of, _BLOCK))


def _floored(asked: pa.RecordBatch) -> np.ndarray:
    """Of each query of a block its floor, as its home cell has given it."""
    out = np.full(len(asked.column("asks")[0].values), -np.inf)
    given = asked.column("floors")[0]
    if given.is_valid and len(given.values):
        out[given.values.field("at").to_numpy()] = given.values.field("floor").to_numpy()
    return out


def _lanes_at_home(found: Index):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                lanes = sorted({_lane(first[x], step[x], 0) for x in np.unique(one.column("homes")[0].values.to_numpy()).tolist()})
                yield pa.RecordBatch.from_arrays([*one.take(pa.array([0] * len(lanes))).columns, pa.array(lanes, pa.int32())], [*batch.schema.names, "lane"])

    first, step = found.first, found.step
    return of


def _lanes_in_reach(found: Index, kind: str):
    """Each block with every lane of cells that may hold a product of the floor or more of one of its queries."""
    pivots, radius, reach, width = found.pivots, found.radius, found.reach, found.shape.width
    own, held = vectors.squares(pivots), np.flatnonzero(found.reach >= 0)
    lanes = {int(cell): list(found.lanes_of(cell)) for cell in held}

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                every, floors, reached = _values(one.column("query_values"), 0, kind, width), _floored(one), np.zeros(len(held), dtype=bool)
                for begin in range(0, len(every), 256):
                    values, floor = every[begin : begin + 256], floors[begin : begin + 256]
                    square = vectors.squares(values)[:, None]
                    products = values @ pivots[held].T
                    apart = np.sqrt(np.maximum(0.0, square + own[held] - 2 * products))
                    limit = np.minimum(_limit(square, reach[held], apart - radius[held] - SLACK * apart), products + np.sqrt(square) * radius[held] * (1 + SLACK) + SLACK * (1 + square))
                    reached |= (limit >= floor[:, None]).any(0)
                into = sorted({lane for cell in held[reached].tolist() for lane in lanes[cell]})
                yield pa.RecordBatch.from_arrays([*one.take(pa.array([0] * len(into))).columns, pa.array(into, pa.int32())], [*batch.schema.names, "lane"])

    return of


def _tree(row: pa.RecordBatch, kind: str, width: int) -> Tree:
    column = lambda name: row.column(name)[0].values.to_numpy(zero_copy_only=False)
    return Tree(
        column("ids"), _values(row.column("tree_values"), 0, kind, width), column("row_apart"), column("low"), column("high"),
        column("leaf"), column("routing"), column("radius"), column("apart"), column("reach"),
    )


def _answers(shape: vectors.Shape, kind: str, k: int, home: bool):
    """The best of a lane's subtrees for a block; home: only the k-th score in the first subtree of each query's own cell."""
    width = shape.width

    def start(rows: list[pa.RecordBatch]):
        trees = [(row.column("cell")[0].as_py(), _tree(row, shape.kind(), width)) for row in rows if not home or row.column("bin")[0].as_py() == 0]
        singles = [tree.values.astype(np.float32) for _, tree in trees]

        def visit(row: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            ids, asks, homes = (row.column(c)[0].values.to_numpy() for c in ("query_ids", "asks", "homes"))
            values = _values(row.column("query_values"), 0, kind, width)
            asked = Asked(ids, values, k, np.full(len(ids), -np.inf) if home else _floored(row))
            most = float(np.sqrt(asked.square.max()))
            for (cell, tree), short in zip(trees, singles):
                fits = vectors.single(most * float(np.sqrt(tree.reach[0]))) is np.float32
                best_of_block(tree, asked, np.flatnonzero(homes == cell) if home else None, short if fits else None)
            if home:
                at = np.flatnonzero(asked.least > -np.inf)
                if len(at):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), row.column("block")[0].as_py())), pa.array(at), pa.array(asked.least[at])], ["block", "at", "floor"])
            elif len(asked.at):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (asks[asked.at], ids[asked.at], asked.vec_id, asked.score)], ["ask", "query_id", "vec_id", "score"])

        return visit

    return start


def search(found: Index, queries: DataFrame, k: int) -> DataFrame:
    """The k highest products of each query (query_id, v): query_id, rank, vec_id, score.

    First each query asks one subtree of the cell nearest to it; its k-th score there is a floor for the rest. Then it asks
    every subtree whose cell may hold a product of the floor or more.
    """
    queries = stored(queries.select(F.col("query_id").alias("vec_id"), "v").distinct().withColumn("ask", F.monotonically_increasing_id()))
    shape = vectors.shape(queries)
    if not shape.rows or not (found.bins > 0).any():
        return queries.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score")).where(F.lit(False))
    if shape.width > found.shape.width:
        raise ValueError("queries are longer than the vectors they ask")
    shape = vectors.Shape(shape.rows, found.shape.width, shape.most)
    blocks, kind = _packed_queries(queries, np.flatnonzero(found.bins > 0), found.pivots, shape), shape.kind()
    at_home = blocks.mapInArrow(_lanes_at_home(found), f"{_BLOCK}, lane int")
    floors = met(found.trees, at_home, found.lanes, "block", _answers(found.shape, kind, k, True), "block long, at long, floor double")
    floors = floors.groupBy("block").agg(F.collect_list(F.struct("at", "floor")).alias("floors"))  # QUERY_BLOCK at most
    asked = blocks.join(floors.hint("merge"), "block", "left").mapInArrow(_lanes_in_reach(found, kind), f"{_BLOCK}, floors array<struct<at:bigint,floor:double>>, lane int")
    parts = met(found.trees, asked, found.lanes, "block", _answers(found.shape, kind, k, False), "ask long, query_id long, vec_id long, score long")
    order = Window.partitionBy("ask").orderBy(F.col("score").desc(), "vec_id")
    return parts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(rows: DataFrame, asked, k: int = 10) -> DataFrame:
    """The k highest products of every row that fits the condition `asked`, with all rows but its own."""
    found = index(rows)
    return search(found, found.rows.where(asked).select(F.col("vec_id").alias("query_id"), "v"), k)
