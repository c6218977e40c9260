"""N-gram Jaccard join by multiple-global-order filtering.

A document is the set of its distinct word shingles, each a 64-bit hash. Whatever the global order of tokens, two linked
sets share tokens in their prefixes; with prefixes longer by some tokens they share at least so many. Several orders
each give such a filter, and a candidate must pass all of them before its sets are compared:

1. Prefixes under a first hash order, of all documents, are sorted by token; documents with too few prefix tokens that
   any other document's prefix holds have no link and are done.
2. The same under a second hash order, for what is left.
3. Stars: documents with the same first token under either order are compared with a bounded number of those met before
   that are not yet joined to them. This joins large groups of near copies in linear time; components of these links need no pair inside compared.
4. Prefixes under a third order, the commonest tokens, counted over all sets, last: pairs still apart that share enough
   rare prefix tokens are compared, and what shares a frequent one is compared with what that token leads to, whole sets
   in blocks. This is exact: every link between components is found.

Documents with equal sets are one node. Defined results: a null, empty or blank text has no shingle and links with
nothing; a shorter text than a shingle is one shingle; rows that repeat are linked; other columns are ignored. Distinct
shingles or sets with one 64-bit hash would be taken for equal; no step depends on there being few documents of a kind.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import by_batch, discard, read_table, tidy, written

WORDS, PERCENT = 4, 85
#: Tokens that are told to be frequent, at most: the third order puts them last.
FREQUENT = 500_000
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


class Shingles:
    """of(text): the sorted distinct shingle hashes (int64)."""

    def __init__(self, words: int = WORDS, cache_words: int = 50_000):
        import xxhash

        self.digest, self.words = xxhash.xxh3_64_intdigest, words
        self.cache: dict[bytes, int] = {}
        self.cache_words = cache_words

    def of(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z only
        if not words:
            return np.zeros(0, "int64")
        if len(words) < self.words:
            return np.array([self.digest(b" ".join(words), seed=len(words))], "uint64").view("int64")
        cache, digest = self.cache, self.digest
        if len(cache) > self.cache_words:
            cache.clear()
        for w in set(words).difference(cache):
            cache[w] = digest(w)
        h = np.fromiter(map(cache.__getitem__, words), "uint64", len(words))
        n = len(h) - self.words + 1
        s = h[:n].copy()
        for k in range(1, self.words):
            s *= _M1
            s += h[k : k + n]
        s ^= s >> np.uint64(31)
        s *= _M2
        s ^= s >> np.uint64(29)
        return np.unique(s.view("int64"))


def _least_overlap(n: int, percent: int) -> int:
    return (percent * n + 99) // 100


def _extra(n: int) -> int:
    """Prefixes are this much longer than one shared token would need."""
    return max(1, n // 20)


def _prefix(n: int, percent: int) -> int:
    return min(n, n - _least_overlap(n, percent) + _extra(n))


def _needed(n: int, percent: int) -> int:
    """Prefix tokens that a set of n shares at least with any set it links to: the least such set is percent as large."""
    return max(1, min(_extra(n), _least_overlap(n, percent) // 20))


def _second(tokens: np.ndarray) -> np.ndarray:
    """Another order of the same tokens."""
    with np.errstate(over="ignore"):
        x = tokens.view("uint64") * _M1
        return (x ^ (x >> np.uint64(32))).view("int64")


def _lists(column) -> list[np.ndarray]:
    at, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    return [values[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def _array(rows: list[np.ndarray]):
    import pyarrow as pa

    ends = np.zeros(len(rows) + 1, "int32")
    np.cumsum([len(r) for r in rows], out=ends[1:])
    return pa.ListArray.from_arrays(ends, np.concatenate(rows) if rows else np.zeros(0, "int64"))


def _in_other_sets(prefixes: DataFrame) -> DataFrame:
    """prefixes(node, prefix) -> (node, shared): how many prefix tokens other nodes' prefixes hold, or a little more.
    Rows are dealt by ranges of (token, node), so a token that very many nodes hold spreads over tasks; where a task or
    batch cuts a token's run, the run counts as shared."""

    @tidy
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            token, node = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if not len(token):
                continue
            edge = np.flatnonzero(np.diff(token)) + 1
            first, last = np.append(0, edge), np.append(edge, len(token)) - 1
            shared = node[first] != node[last]
            shared[0] = shared[-1] = True
            nodes, counts = np.unique(node[np.repeat(shared, last - first + 1)], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(counts, pa.int64())], names=["node", "shared"])

    rows = prefixes.select(F.explode("prefix").alias("token"), "node")
    sorted_rows = rows.repartitionByRange("token", "node").sortWithinPartitions("token", "node")
    return sorted_rows.mapInArrow(run, "node long, shared long").groupBy("node").agg(F.sum("shared").alias("shared"))


def _enough(shared: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    n = F.col("n")
    least = F.expr(f"({percent} * n + 99) div 100")
    needed = F.greatest(F.lit(1), F.least(F.greatest(F.lit(1), F.expr("n div 20")), (least / 20).cast("long")))
    return sizes.join(shared, "node").where(F.col("shared") >= needed).drop("shared")


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(a) + len(b)
    if percent * max(len(a), len(b)) > 100 * min(len(a), len(b)):
        return False
    x = np.concatenate((a, b))
    x.sort(kind="stable")  # two sorted runs
    shared = int(np.count_nonzero(x[1:] == x[:-1]))
    return 100 * shared >= percent * (both - shared)


class Group:
    """Nodes that share a first token, met one after another: links are looked for between what is not yet joined."""

    def __init__(self, percent: int, kept: int, tries: int):
        self.percent, self.kept, self.tries = percent, kept, tries
        self.up: dict[int, int] = {}
        self.known: list[tuple[int, np.ndarray]] = []

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def meet(self, node: int, tokens: np.ndarray) -> list[tuple[int, int]]:
        self.up[node], tried, found = node, 0, []
        mine = node
        for other, its in reversed(self.known):
            if self.root(other) == mine:
                continue
            tried += 1
            if _linked(its, tokens, self.percent):
                # Told of the joined sets' first nodes: the links of a group are a star, not a chain.
                first = self.root(other)
                found.append((first, mine))
                self.up[mine] = mine = first
            if tried >= self.tries:
                break
        self.known.append((node, tokens))
        if len(self.known) > self.kept:
            # Of what is best represented the oldest goes, so that loners stay to be found.
            roots = [self.root(k) for k, _ in self.known]
            most = max(set(roots), key=roots.count)
            self.known.pop(roots.index(most))
        return found


def _stars(sets: DataFrame, key: str, percent: int, kept: int, tries: int) -> DataFrame:
    """(u, v) links, found by comparing each node with up to `tries` of the `kept` nodes that have its first token and
    are not yet joined to it, in the order of the sorted partition. Where a partition ends, a group ends."""

    @tidy
    def run(batches):
        import pyarrow as pa

        here, group = None, None
        for batch in batches:
            keys, node = (batch.column(k).to_numpy(zero_copy_only=False).tolist() for k in (0, 1))
            found = []
            for i, tokens in enumerate(_lists(batch.column(2))):
                if here != keys[i]:
                    here, group = keys[i], Group(percent, kept, tries)
                found += group.meet(node[i], tokens.copy())
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], names=["u", "v"])

    return sets.sortWithinPartitions(key, "n", "node").select(key, "node", "tokens").mapInArrow(run, "u long, v long")


def _frequent(sets: DataFrame, few: int, most: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """(tokens ascending, levels): the tokens of more than `few` sets and the logarithm of how many hold them; of the
    commonest levels as many as `most` tokens fill. It sets an order only: a token left out makes the search longer, not
    its result different. Near copies lie together in sets, so most is counted before the shuffle."""
    level = F.floor(F.log2("holders")).cast("int")
    counted = sets.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("holders"))
    common = written(counted.where(F.col("holders") > few).select("token", level.alias("level")))
    sizes = sorted(common.groupBy("level").count().collect(), reverse=True)  # a row for each power of two
    room, least = most, 64
    for r in sizes:
        room -= r[1]
        if room < 0:
            break
        least = r[0]
    kept = common.where(F.col("level") >= least).sort("token").toArrow()  # `most` rows of two numbers at most
    discard(common)
    return kept.column(0).to_numpy(), kept.column(1).to_numpy().astype("int8")


def _third_prefixes(sets: DataFrame, frequent: tuple[np.ndarray, np.ndarray], percent: int) -> DataFrame:
    """(node, n, component, token) of the prefixes under the third order: frequent tokens last, by level, then by hash."""
    sent = sets.sparkSession.sparkContext.broadcast(frequent)  # FREQUENT rows of two numbers at most

    @tidy
    def run(batches):
        import pyarrow as pa

        known, levels = sent.value
        for batch in batches:
            rows = []
            for tokens in _lists(batch.column(3)):
                level = np.zeros(len(tokens), "int8")
                if len(known):
                    at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
                    level = np.where(known[at] == tokens, levels[at], 0)
                order = np.lexsort((_second(tokens) ^ np.int64(0x5555555555555555), level))
                rows.append(tokens[order[: _prefix(len(tokens), percent)]])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), _array(rows)], names=["node", "n", "component", "prefix"])

    prefixes = sets.select("node", "n", "component", "tokens").mapInArrow(run, "node long, n long, component long, prefix array<long>")
    return prefixes.select("node", "n", "component", F.explode("prefix").alias("token"))


def _mixed(rows: DataFrame) -> DataFrame:
    """(token, holders, largest): tokens that nodes of several components hold, how many nodes, and the component that
    most of them are of."""
    by_part = rows.groupBy("token", "component").agg(F.count("*").alias("members"))
    by_token = by_part.groupBy("token").agg(F.max(F.struct("members", "component")).alias("top"), F.count("*").alias("parts"), F.sum("members").alias("holders"))
    return by_token.where("parts > 1").select("token", "holders", F.col("top.component").alias("largest"))


def _rare_pairs(some: DataFrame, percent: int, few: int) -> DataFrame:
    """(u, v): pairs of different components that share enough prefix tokens, counting those of at most `few` holders:
    no more than `few` rows for a prefix token. Pairs that share a more frequent one are met in _across."""
    some = some.where(F.col("holders") <= few)
    left = some.select("token", F.col("node").alias("u"), F.col("n").alias("un"), F.col("component").alias("uc"))
    right = some.select("token", F.col("node").alias("v"), F.col("n").alias("vn"), F.col("component").alias("vc"))
    pairs = left.join(right, "token").where(f"u < v and uc <> vc and {percent} * greatest(un, vn) <= 100 * least(un, vn)")
    extra = F.least(F.greatest(F.lit(1), F.expr("un div 20")), F.greatest(F.lit(1), F.expr("vn div 20")))
    return pairs.groupBy("u", "v", extra.alias("needed")).agg(F.count("*").alias("common")).where("common >= needed").select("u", "v")


def _across(some: DataFrame, sets: DataFrame, percent: int, few: int, block_rows: int = 256, at_once: int = 1 << 18) -> DataFrame:
    """(u, v): links between components by tokens of more than `few` holders, at least one for each node and component.
    Such a token leads its other nodes to its largest component. Each node so led, if it shares enough prefix tokens at
    all, is compared with that component's nodes and with the others led there, block by block: a pair that shares such
    a token meets there, and no row is made for a pair."""
    needed = F.greatest(F.lit(1), F.least(F.greatest(F.lit(1), F.expr("n div 20")), F.expr(f"(({percent} * n + 99) div 100) div 20")))
    able = some.groupBy("node", "n", "component").agg(F.count("*").alias("tokens")).where(F.col("tokens") >= needed).select("node", "component")
    led = some.where((F.col("component") != F.col("largest")) & (F.col("holders") > few)).select("node", F.col("largest").alias("group")).distinct().join(able, "node")
    groups = led.select("group").distinct()
    own = able.select("node", "component", F.col("component").alias("group")).join(groups, "group")
    columns = ["node", "component", "group"]
    places = written(own.select(*columns, F.lit(False).alias("asks")).unionByName(led.select(*columns, F.lit(True).alias("asks"))))
    blocks = places.groupBy("group").agg(F.expr(f"(count(*) div {block_rows}) + 1").alias("blocks"))
    filled = places.join(blocks, "group").join(sets.select("node", "tokens"), "node")
    here = F.struct(F.pmod(F.xxhash64("node"), "blocks").alias("block"), F.lit(0).alias("kind"))
    asked = F.transform(F.expr("sequence(0L, blocks - 1)"), lambda b: F.struct(b.alias("block"), F.lit(1).alias("kind")))
    spread = filled.withColumn("to", F.explode(F.when(F.col("asks"), F.concat(F.array(here), asked)).otherwise(F.array(here))))

    def chunks(held):
        """The held sets end to end, about `at_once` tokens at a time, which bounds what a comparison takes."""
        begin, size = 0, 0
        for end in range(1, len(held) + 1):
            size += len(held[end - 1][2])
            if size >= at_once or end == len(held):
                part = held[begin:end]
                sizes = np.array([len(t) for _, _, t in part])
                yield np.concatenate([t for _, _, t in part]), np.append(0, np.cumsum(sizes)[:-1]), sizes, np.array([x for x, _, _ in part]), np.array([c for _, c, _ in part])
                begin, size = end, 0

    @tidy
    def run(batches):
        import pyarrow as pa

        now, held, block = None, [], None
        for batch in batches:
            group, at, kind, node, part = (batch.column(k).to_numpy(zero_copy_only=False).tolist() for k in range(5))
            found = []
            for i, tokens in enumerate(_lists(batch.column(5))):
                if now != (group[i], at[i]):
                    now, held, block = (group[i], at[i]), [], None
                if kind[i] == 0:
                    held.append((node[i], part[i], tokens.copy()))
                    continue
                if not held:
                    continue
                if block is None:
                    block = list(chunks(held))
                told = set()
                for values, starts, sizes, nodes_, parts_ in block:
                    k = np.minimum(np.searchsorted(tokens, values), len(tokens) - 1)
                    shared = np.add.reduceat((tokens[k] == values).astype("int32"), starts)
                    hit = np.flatnonzero((100 * shared >= percent * (sizes + len(tokens) - shared)) & (parts_ != part[i]))
                    for c in hit.tolist():
                        if parts_[c] not in told:
                            told.add(parts_[c])
                            found.append((node[i], int(nodes_[c])))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], names=["u", "v"])

    flat = spread.select("group", F.col("to.block").alias("block"), F.col("to.kind").alias("kind"), "node", "component", "tokens")
    return flat.repartition("group", "block").sortWithinPartitions("group", "block", "kind").mapInArrow(run, "u long, v long")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    side = lambda k: sets.select(F.col("node").alias(k), F.col("tokens").alias(f"{k}_tokens"))

    @tidy
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            keep = []
            for a, b in zip(_lists(batch.column(2)), _lists(batch.column(3)), strict=True):
                pa_, pb = _prefix(len(a), percent), _prefix(len(b), percent)
                need = min(_extra(len(a)), _extra(len(b)))
                # First order, then second, then all of both sets.
                ok = np.intersect1d(a[:pa_], b[:pb], assume_unique=True).size >= need
                if ok:
                    x, y = np.sort(_second(a))[:pa_], np.sort(_second(b))[:pb]
                    ok = np.intersect1d(x, y, assume_unique=True).size >= need and _linked(a, b, percent)
                keep.append(bool(ok))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep)) for c in batch.columns[:2]], names=["u", "v"])

    joined = pairs.join(side("u"), "u").join(side("v"), "v").select("u", "v", "u_tokens", "v_tokens")
    return joined.mapInArrow(run, "u long, v long")


def _row_hash():
    """Names a row, null doc_id or not."""
    return F.xxhash64("doc_id", "text")


def _parts(docs: DataFrame, *, words: int = WORDS, percent: int = PERCENT, kept: int = 96, tries: int = 64, few: int = 32, broadcast_rows: int = 500_000) -> DataFrame:
    """(row, doc_id, n_shingles, first) for every row of docs(doc_id, text). first is the struct (none, doc_id, row) of
    the least row of the component (null doc_ids last); null where a row is linked with nothing and repeated nowhere."""
    import xxhash

    def small(df: DataFrame) -> DataFrame:
        """For a join with narrow rows: broadcast if there are few, by count, else left to a shuffle."""
        return F.broadcast(df) if df.count() <= broadcast_rows else df.hint("merge")

    def node_of(s: np.ndarray) -> int:
        return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)

    def first_start():
        shingles = Shingles(words)

        def work(rows, doc_ids, texts):
            sets = [shingles.of(t) for t in texts]
            return [rows, doc_ids, [node_of(s) if len(s) else None for s in sets], [len(s) for s in sets], _array([s[: _prefix(len(s), percent)] for s in sets])]

        return work

    table = written(by_batch(docs, [_row_hash().alias("row"), "doc_id", "text"], "row long, doc_id long, node long, n long, prefix array<long>", first_start))
    some = table.where("n > 0")
    nodes = some.groupBy("node").agg(F.min("n").alias("n"), F.min("row").alias("own"))
    left = written(_enough(_in_other_sets(some), nodes, percent))

    def sets_of(nodes_: DataFrame, second_prefix: bool) -> DataFrame:
        """The sets of nodes_(node, own), one row a node, or their prefixes under the second order."""

        def start():
            shingles = Shingles(words)

            def work(nodes_, texts):
                sets = [shingles.of(t) for t in texts]
                # Another row may have the hash of a node's row.
                pairs = [(k, s) for k, s in zip(nodes_, sets, strict=True) if len(s) and node_of(s) == k]
                keys, values = [p[0] for p in pairs], [p[1] for p in pairs]
                second = [np.sort(_second(s)) for s in values]
                sizes = [len(s) for s in values]
                if second_prefix:
                    return [keys, sizes, _array([x[: _prefix(len(x), percent)] for x in second])]
                return [keys, sizes, _array(values), [s[0] for s in values], [x[0] for x in second]]

            return work

        schema = "node long, n long, prefix array<long>" if second_prefix else "node long, n long, tokens array<long>, first long, second long"
        return by_batch(docs.select(_row_hash().alias("row"), "text").join(small(nodes_.select(F.col("own").alias("row"), "node")), "row"), ["node", "text"], schema, start)

    prefixes = written(sets_of(left, True))
    again = written(_enough(_in_other_sets(prefixes.select("node", "prefix")), left, percent))
    discard(prefixes, left)
    sets = sets_of(again, False)
    if table.groupBy("row").count().where("count > 1").limit(1).count():
        sets = sets.dropDuplicates(["node"])
    # Kept in ranges of the first token: near copies mostly lie together.
    sets = written(sets.repartitionByRange("first", "node"))

    stars = _stars(sets, "first", percent, kept, tries).unionByName(_stars(sets.repartitionByRange("second", "node"), "second", percent, kept, tries))
    label = written(components(stars))
    labelled = sets.join(small(label), "node", "left").withColumn("component", F.coalesce("component", "node"))
    rows = written(_third_prefixes(labelled, _frequent(sets, few), percent))
    shared = written(rows.join(_mixed(rows), "token"))
    discard(rows)
    more = written(_across(shared, sets, percent, few).unionByName(_verified(written(_rare_pairs(shared, percent, few)), sets, percent)))
    discard(shared, sets, again)
    if more.limit(1).count():
        label = components(label.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(more))

    # What is shared by rows of a node or nodes of a component is told by node: copies by the thousand are one node.
    row = F.struct(F.isnull("doc_id").alias("none"), "doc_id", "row")
    by_node = some.groupBy("node").agg(F.min(row).alias("least"), F.count("*").alias("rows"))
    told = written(by_node.join(label, "node", "left").where("component is not null or rows > 1").select("node", F.coalesce("component", "node").alias("component"), "least"))
    firsts = told.groupBy("component").agg(F.min("least").alias("first"))
    told = small(written(told.join(small(firsts), "component").select("node", "first")))
    return table.select("row", "doc_id", F.col("n").alias("n_shingles"), "node").join(told, "node", "left").select("row", "doc_id", "n_shingles", "first")


def ngram_join(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of docs(doc_id, text). Rows with a null doc_id link others and get
    their component_id; it is null where all of a component have none."""
    return _parts(docs, **options).select("doc_id", "n_shingles", F.coalesce("first.doc_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, broadcast_rows: int = 1_000_000, **options) -> DataFrame:
    """Of each component the row with the least doc_id (null is the greatest; of equal ones that with the least hash of
    doc_id and text), and the rows without shingles, with all their columns. Rows that share a doc_id are decided each;
    exact repeats of a row's doc_id and text are given once."""
    some = written(_parts(docs, **options).where("first is not null").select(F.col("row").alias("_row"), F.col("first.row").alias("first")))
    gone = written(some.where("_row <> first").select("_row").distinct())
    gone = F.broadcast(gone) if gone.count() <= broadcast_rows else gone.hint("merge")
    kept = docs.withColumn("_row", _row_hash()).join(gone, "_row", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
    repeated = some.groupBy("_row").count().where("count > 1").limit(1).count()
    return kept.dropDuplicates(["doc_id", "text"]) if repeated else kept


def op4_ngram_join(spark, sf_dir: str) -> DataFrame:
    return ngram_join(read_table(spark, sf_dir, "documents"))
