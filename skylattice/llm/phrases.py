"""Phrase collocation mining by dynamic itemset counting.

Texts are cut into pieces at punctuation and line ends, pieces into words; everything is counted per language. The
corpus is dealt into a few shards that are scanned in a cycle. The first scans count single words; once both subphrases
of a longer phrase (all but its last word, all but its first) have reached the threshold, it is counted too, from the
next shard on, until the scans come round to where it started. So lengths interleave, a phrase is counted over each
shard exactly once, and a phrase with a rare subphrase is hardly ever counted.

A phrase is a 64-bit key, made from its language and words; the low bits are its length, 0 standing for the words of a
language. Tasks learn which phrases have reached the threshold, and in which scan, from one table of fixed size with a
byte for each slot of keys. Two keys may share a slot: then a phrase may be counted that need not be, never the other
way round, and since a slot never changes once it is set, all tasks agree on where a phrase started. Counts are summed
inside a task before they are shuffled, so a word or a phrase that fills the corpus is a row a task.

When nothing is left to be counted, one more scan reads the texts of the phrases that reached the threshold. Scores are
exact decimals.

Defined results: a null text is empty; a null language is `und`. Rows that repeat count as often. An empty table gives
no rows. Other columns of an input, doc_id among them, are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import discard, read_table, tidy, written

LEAST = 10
LONGEST = 3
TOP = 2000
SHARDS = 3
SLOT_BITS = 24
#: Keys that a task gathers before it counts them, and bytes of text that it reads at a time.
BUFFER_KEYS = 1_000_000
STRETCH = 2**19

LENGTH_BITS = 3
NEVER = 255
#: 0xff is no byte of UTF-8: it marks where pieces end.
_END = b"\xff"
_PLAIN = bytes(255 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b in b" \t" else b + 32 if 65 <= b <= 90 else b for b in range(256))
COUNTS = "key long, n long, start int"


def _mixed(a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """The key of a phrase of `length` words from those of its first words and its last word."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return (x & ~np.uint64(2**LENGTH_BITS - 1)) | np.uint64(length)


def _finished(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Tokens:
    """Of some texts together: where in `data` each token begins and ends, and its key; 0 stands where a piece ends. of:
    which text a token belongs to."""

    data: bytes
    starts: np.ndarray
    ends: np.ndarray
    keys: np.ndarray
    of: np.ndarray

    def text(self, first: int, length: int) -> str:
        return b" ".join(self.data[self.starts[first] : self.ends[first + length - 1]].split()).decode()


class Reader:
    """Texts as tokens with keys. A word's hash is a polynomial of its bytes' random numbers, modulo 2 ** 64: running sums
    over a stretch of text give the hashes of all its words at once, wherever they lie in it."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self):
        import xxhash

        self.digest = xxhash.xxh3_64_intdigest
        self.table = np.array([self.digest(bytes([b])) for b in range(256)], "uint64")
        self.languages: dict[str | None, tuple[int, int]] = {}
        self.powers = self.inverse = np.array([], "uint64")

    def language(self, lang: str | None) -> tuple[int, int]:
        """The seed of a language's words, and the key of its number of words."""
        got = self.languages.get(lang)
        if got is None:
            seed = self.digest(("und" if lang is None else lang).encode("utf-8", "replace"))
            got = self.languages[lang] = seed, seed >> LENGTH_BITS << LENGTH_BITS
        return got

    def hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(data) > len(self.powers):
            n = max(len(data), 2 * STRETCH)
            inverse = pow(self.BASE, -1, 2**64)
            self.powers, self.inverse = (np.cumprod(np.full(n, b, "uint64")) for b in (self.BASE, inverse))
        sums = np.cumsum(self.table[data] * self.powers[: len(data)])
        before = np.where(starts > 0, sums[starts - 1], np.uint64(0))
        return (sums[ends - 1] - before) * self.inverse[starts]

    def read(self, langs: list[str | None], texts: list[bytes | None]) -> Tokens:
        plain = [(t or b"").translate(_PLAIN) + _END for t in texts]
        data = b"".join(plain)
        whole = np.frombuffer(data, "uint8")
        parts, at = [], 0
        while at < len(data):
            # Stretches end at a blank or where a piece ends, so that no word is cut.
            stop = min(len(data), at + STRETCH)
            if stop < len(data):
                blank, end = data.rfind(b" ", at, stop), data.rfind(_END, at, stop)
                stop = max(blank, end) + 1 or min(x for x in (data.find(b" ", stop), data.find(_END, stop)) if x >= 0) + 1
            part = whole[at:stop]
            word, end = (part != 32) & (part != 255), part == 255
            first, last = word.copy(), word.copy()
            first[1:] &= ~word[:-1]
            last[:-1] &= ~word[1:]
            token = np.flatnonzero(first | end)
            is_word = ~end[token]
            ends, keys = token.copy(), np.zeros(len(token), "uint64")
            ends[is_word] = np.flatnonzero(last) + 1
            keys[is_word] = self.hashes(part, token[is_word], ends[is_word])
            parts.append((token + at, ends + at, keys, is_word))
            at = stop
        starts, ends, keys, is_word = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.array([], "int64"),) * 2 + (np.array([], "uint64"), np.array([], bool))
        begins = np.cumsum([0, *map(len, plain)])
        counts = np.diff(np.searchsorted(starts, begins))
        of = np.repeat(np.arange(len(texts)), counts)
        seeds = np.array([self.language(x)[0] for x in langs], "uint64")[of]
        mixed = _finished(keys + seeds) >> np.uint64(LENGTH_BITS) << np.uint64(LENGTH_BITS) | np.uint64(1)
        return Tokens(data, starts, ends, np.where(is_word, mixed, np.uint64(0)), of)


def _blocks(batches, texts_at: int):
    """Columns of rows, some at a time: no more than 500, nor many more bytes of text than STRETCH."""
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        begin = size = 0
        for k, text in enumerate(columns[texts_at]):
            size += len(text or b"")
            if size >= STRETCH or k + 1 - begin == 500 or k + 1 == batch.num_rows:
                yield [c[begin : k + 1] for c in columns]
                begin, size = k + 1, 0


class Tally:
    """Keys counted, by the scan their phrase started in."""

    def __init__(self):
        self.parts: dict[int, list[tuple[np.ndarray, np.ndarray]]] = defaultdict(list)
        self.loose: dict[int, list[np.ndarray]] = defaultdict(list)
        self.n_loose = 0

    def add(self, start: int, keys: np.ndarray) -> None:
        if len(keys):
            self.loose[start].append(keys)
            self.n_loose += len(keys)

    def full(self) -> bool:
        """Whether, once what is loose is counted, there are enough keys to be given out."""
        if self.n_loose < BUFFER_KEYS:
            return False
        self.count()
        return sum(len(k) for parts in self.parts.values() for k, _ in parts) > 2 * BUFFER_KEYS

    def count(self) -> None:
        for start, loose in self.loose.items():
            keys, n = np.unique(np.concatenate(loose), return_counts=True)
            self.parts[start] = [_summed([*self.parts[start], (keys, n)])]
        self.loose.clear()
        self.n_loose = 0

    def take(self):
        self.count()
        for start, parts in self.parts.items():
            for keys, n in parts:
                yield start, keys, n
        self.parts.clear()


def _summed(parts):
    if len(parts) == 1:
        return parts[0]
    keys, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(n, first)


def phrases_of(words: np.ndarray, slots: np.ndarray, longest: int):
    """For each length from 2: (positions, keys, start) of the phrases whose two subphrases have reached the threshold, by
    the slots, and the scan they start in. A phrase that shares its slot may find it set before it has itself been
    counted: it reaches the threshold no sooner than the scan it starts in."""
    shift = np.uint64(64 - int(len(slots)).bit_length() + 1)
    at = np.flatnonzero(words)
    keys, start = words[at], np.zeros(len(at), "int64")
    for length in range(2, longest + 1):
        reached = slots[keys >> shift]
        good = reached != NEVER
        at, keys, reached = at[good], keys[good], np.maximum(reached[good], start[good])
        pair = np.flatnonzero(at[1:] == at[:-1] + 1)
        start = np.maximum(reached[pair], reached[pair + 1]) + 1
        keys = _mixed(keys[pair], words[at[pair] + (length - 1)], length)
        at = at[pair]
        yield length, at, keys, start


def _scanned(shard: DataFrame, slots, scan: int, shards: int, longest: int) -> DataFrame:
    """COUNTS of a shard in one scan."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    wanted = to_arrow_schema(StructType.fromDDL(COUNTS))

    @tidy
    def run(batches):
        import pyarrow as pa

        reader, tally, totals = Reader(), Tally(), defaultdict(int)
        table = np.frombuffer(slots.value, "uint8")

        def given():
            for start, keys, n in tally.take():
                for k in range(0, len(keys), 100_000):
                    part = keys[k : k + 100_000]
                    yield pa.RecordBatch.from_arrays([pa.array(part.view("int64")), pa.array(n[k : k + 100_000]), pa.array(np.full(len(part), start, "int32"))], schema=wanted)

        for langs, texts in _blocks(batches, 1):
            tokens = reader.read(langs, texts)
            words = tokens.keys
            if scan < shards:
                tally.add(0, words[words != 0])
                for lang, n in zip(langs, np.bincount(tokens.of[words != 0], minlength=len(langs)).tolist(), strict=True):
                    totals[reader.language(lang)[1]] += n
            for _, _, keys, start in phrases_of(words, table, longest):
                for s in range(max(1, scan - shards + 1), scan + 1):
                    tally.add(s, keys[start == s])
            if tally.full():
                yield from given()
        keys = np.array(list(totals), "uint64")
        tally.parts[0].append((keys, np.array(list(totals.values()), "int64")))
        yield from given()

    return shard.select("lang", F.col("text").cast("binary")).mapInArrow(run, COUNTS)


def _resolved(dealt: DataFrame, slots, claims, longest: int) -> DataFrame:
    """(key, lang, phrase) of all phrases, words and languages that reached the threshold. claims: a byte a slot, with a
    bit for each shard in which a phrase of the slot is to be looked for, so that it is told by the tasks of one shard
    instead of all; a task tells it once, or again when it has told BUFFER_KEYS others."""
    schema = "key long, lang string, phrase string"

    @tidy
    def run(batches):
        import pyarrow as pa

        reader, told, totals = Reader(), np.array([], "uint64"), set()
        reached, claimed = np.frombuffer(slots.value, "uint8"), np.frombuffer(claims.value, "uint8")
        shift = np.uint64(64 - int(len(reached)).bit_length() + 1)

        def block(shard, langs, texts):
            nonlocal told
            bit = np.uint8(1 << shard)
            tokens = reader.read(langs, texts)
            words = tokens.keys
            one = np.flatnonzero(words)
            found = [(1, one, words[one]), *[(length, place, keys) for length, place, keys, _ in phrases_of(words, reached, longest)]]
            out = [(reader.language(lang)[1], lang, "") for lang in set(langs) - totals]
            totals.update(langs)
            fresh = []
            for length, place, keys in found:
                here = np.flatnonzero(claimed[keys >> shift] & bit)
                keys, first = np.unique(keys[here], return_index=True)
                new = ~np.isin(keys, told, assume_unique=True)
                keys, place = keys[new], place[here[first[new]]]
                fresh.append(keys)
                out += [(key, langs[d], tokens.text(p, length)) for key, d, p in zip(keys.tolist(), tokens.of[place].tolist(), place.tolist(), strict=True)]
            told = np.concatenate([told, *fresh])
            if len(told) > BUFFER_KEYS:
                told = told[:0]
            keys, names, phrases = zip(*out, strict=True) if out else ((), (), ())
            names = ["und" if x is None else x for x in names]
            columns = [pa.array(np.array(keys, "uint64").view("int64")), pa.array(names, "string"), pa.array(phrases, "string")]
            return pa.RecordBatch.from_arrays(columns, names=["key", "lang", "phrase"])

        for shards, langs, texts in _blocks(batches, 2):
            for shard in set(shards):
                mine = [i for i, x in enumerate(shards) if x == shard]
                yield block(shard, [langs[i] for i in mine], [texts[i] for i in mine])

    return dealt.select("shard", "lang", F.col("text").cast("binary")).mapInArrow(run, schema)


def _length():
    return F.col("key").bitwiseAND(2**LENGTH_BITS - 1)


def _bitmap(keys: DataFrame, slot_bits: int, *by: str) -> DataFrame:
    """(by, word, bits, shortest): a bitmap of the slots of keys(key, by), 64 a row."""
    slot = F.shiftrightunsigned("key", 64 - slot_bits)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(63).cast("int"))
    return keys.groupBy(*by, F.shiftright(slot, 6).alias("word")).agg(F.bit_or(bit).alias("bits"), F.min(_length()).alias("shortest"))


def _places(words: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """The slots of a bitmap."""
    row, bit = np.nonzero(np.unpackbits(bits.astype("<i8").view("uint8").reshape(-1, 8), axis=1, bitorder="little"))
    return words[row] * 64 + bit


@dataclass
class Counted:
    """phrases: (lang, words, phrase, a) of all phrases that reached the threshold, single words among them; totals:
    (lang, n) of all languages; scans: how many scans of a shard it took."""

    phrases: DataFrame
    totals: DataFrame
    scans: int


def count_phrases(docs: DataFrame, *, least: int = LEAST, longest: int = LONGEST, shards: int = SHARDS, slot_bits: int = SLOT_BITS) -> Counted:
    """Count the phrases of docs(lang, text) of up to `longest` words that occur `least` times or more. slot_bits sets the
    size of the table that tasks get, not the result: 2 ** slot_bits should be well above the number of such phrases."""
    if not 1 <= longest < 2**LENGTH_BITS or not 6 <= slot_bits <= 30 or least < 1 or not 1 <= shards <= 8:
        raise ValueError(f"phrases go from 1 to {2**LENGTH_BITS - 1} words, slot_bits from 6 to 30, shards from 1 to 8, least from 1")
    spark = docs.sparkSession
    # Dealt once, so that a scan reads its own shard only.
    own = [c for c in ("lang", "text", "doc_id") if c in docs.columns]
    dealt = written(docs.select("lang", "text", F.pmod(F.xxhash64(*own), F.lit(shards)).cast("int").alias("shard")), by="shard")
    slots = np.full(2**slot_bits, NEVER, "uint8")
    state, scan, last = None, 0, -1  # last: the scan in which a phrase that can grow reached the threshold last
    while scan < shards or scan <= last + shards:
        if scan >= NEVER:
            raise ValueError("more scans than a slot can tell: take fewer shards or shorter phrases")
        sent = spark.sparkContext.broadcast(slots.tobytes())  # 2 ** slot_bits bytes, however large the corpus
        rows = _scanned(dealt.where(F.col("shard") == scan % shards), sent, scan, shards, longest).withColumn("reached", F.lit(None).cast("int"))
        if state is not None:
            rows = rows.unionByName(state)
        summed = rows.groupBy("key").agg(F.sum("n").alias("n"), F.min("start").alias("start"), F.min("reached").alias("reached"))
        summed = summed.withColumn("reached", F.coalesce("reached", F.when(F.col("n") >= least, F.lit(scan))))
        # What has been all the way round without reaching the threshold goes.
        on_its_way = F.col("start") + (shards - 1) > scan
        before, state = state, written(summed.where(on_its_way | F.col("reached").isNotNull() | (_length() == 0)))
        sent.destroy()
        if before is not None:
            discard(before)
        found = _bitmap(state.where((F.col("reached") == scan) & (_length() > 0)), slot_bits).toArrow()  # 2 ** slot_bits / 64 rows at most
        if found.num_rows:
            at = _places(found["word"].to_numpy(), found["bits"].to_numpy())
            slots[at[slots[at] == NEVER]] = scan
            if found["shortest"].to_numpy().min() < longest:
                last = scan
        scan += 1
    # A phrase that reached the threshold in a scan occurs in that scan's shard.
    claims = np.zeros(2**slot_bits, "uint8")
    kept = state.where((F.col("n") >= least) & (_length() > 0)).withColumn("shard", F.col("reached") % shards)
    found = _bitmap(kept, slot_bits, "shard").toArrow()  # shards times as many rows at most
    at_shard = found["shard"].to_numpy()
    for shard in range(shards):
        rows = np.flatnonzero(at_shard == shard)
        claims[_places(found["word"].to_numpy()[rows], found["bits"].to_numpy()[rows])] |= 1 << shard
    sent, told = spark.sparkContext.broadcast(slots.tobytes()), spark.sparkContext.broadcast(claims.tobytes())
    texts = _resolved(dealt, sent, told, longest).groupBy("key").agg(F.first("lang").alias("lang"), F.first("phrase").alias("phrase"))
    counts = state.where((F.col("n") >= least) | (_length() == 0)).select("key", "n")
    counted = written(counts.join(texts, "key").select("lang", _length().cast("int").alias("words"), "phrase", F.col("n").alias("a")))
    sent.destroy()
    told.destroy()
    discard(state, dealt)
    return Counted(counted.where("words > 0"), counted.where("words = 0").select("lang", F.col("a").alias("n")), scan)


def collocations(counted: Counted, top: int = TOP, part_percent: int = 50) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's `top` phrases of two words or more by the score of their
    weakest cut, without those that lie in a longer one which makes up part_percent of their occurrences."""
    known = counted.phrases
    words, exact = F.split("phrase", " "), "decimal(15,0)"
    phrases = known.where("words >= 2")
    cut = F.col("k")
    cuts = phrases.withColumn("k", F.explode(F.expr("sequence(1, words - 1)"))).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice(words, F.lit(1), cut), " ").alias("left"),
        F.array_join(F.slice(words, cut + 1, F.col("words") - cut), " ").alias("right"),
    )
    left = known.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l"))
    right = known.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r"))
    score = f"cast((1000000 * cast(a as {exact}) * cast(a as {exact})) div (cast(l as {exact}) * cast(r as {exact})) as long)"
    scored = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).withColumn("score", F.expr(score))
    weakest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = F.expr("flatten(transform(sequence(2, words - 1), n -> transform(sequence(1, words - n + 1), p -> array_join(slice(split(phrase, ' '), p, n), ' '))))")
    longer = phrases.where("words >= 3").select("lang", F.explode(inner).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = weakest.join(longer, ["lang", "phrase"], "left").where(F.coalesce(F.col("longer") * 100 < F.col("a") * part_percent, F.lit(True)))
    rows = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # In two steps, so that a language is many tasks' work.
    rows = rows.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    rows = rows.withColumn("rank", F.row_number().over(W.partitionBy("lang", "_part").orderBy(*order))).where(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return rows.join(counted.totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_phrases(spark, sf_dir: str) -> DataFrame:
    """The collocations of each language of the table."""
    return collocations(count_phrases(read_table(spark, sf_dir, "documents")))


OP11_SQL = r"""
WITH pieces_ AS (
  SELECT row_number() OVER () AS p, lang, piece FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) AS piece
    FROM documents)
),
split_ AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS ws FROM pieces_),
grams_ AS (
  SELECT lang, m, unnest([array_to_string(ws[i : i + m - 1], ' ') FOR i IN range(1, len(ws) - m + 2)]) AS phrase
  FROM split_, (VALUES (1), (2), (3)) AS sizes(m) WHERE len(ws) >= m
),
counted_ AS (SELECT lang, m, phrase, count(*) AS a FROM grams_ GROUP BY lang, m, phrase),
totals_ AS (SELECT lang, sum(a)::BIGINT AS n FROM counted_ WHERE m = 1 GROUP BY lang),
candidates_ AS (SELECT lang, m, phrase, string_split(phrase, ' ') AS ws, a FROM counted_ WHERE m >= 2 AND a >= 10),
cuts_ AS (
  SELECT c.lang, c.phrase, c.a, k, array_to_string(ws[1 : k], ' ') AS lhs, array_to_string(ws[k + 1 : m], ' ') AS rhs
  FROM candidates_ c, (VALUES (1), (2)) AS cuts(k) WHERE k < m
),
scored_ AS (
  SELECT c.lang, c.phrase, c.a, k, x.a AS l, y.a AS r,
    ((1000000::HUGEINT * c.a * c.a) // (x.a::HUGEINT * y.a))::BIGINT AS score
  FROM cuts_ c JOIN counted_ x ON x.lang = c.lang AND x.phrase = c.lhs JOIN counted_ y ON y.lang = c.lang AND y.phrase = c.rhs
),
weakest_ AS (SELECT * FROM scored_ QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside_ AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, unnest([array_to_string(ws[1 : 2], ' '), array_to_string(ws[2 : 3], ' ')]) AS phrase, a FROM candidates_ WHERE m = 3
  ) GROUP BY lang, phrase
),
kept_ AS (
  SELECT w.* FROM weakest_ w LEFT JOIN inside_ i ON i.lang = w.lang AND i.phrase = w.phrase
  WHERE i.longer IS NULL OR 100 * i.longer < 50 * w.a
),
ranked_ AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept_)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked_ JOIN totals_ USING (lang) WHERE rank <= 2000
"""
