"""Keyword-stuffed and link-list pages: phrases listed on many hosts, counted by distinct hosts, and link density.

A page that stuffs lists its phrases: the same two words stand again and again, close together, each time between
other words. Prose repeats whole sentences, where a phrase always has the same neighbours, and forms and registers
repeat a row, where one side of a phrase is fixed. So, without any list of words or knowledge of the language:

1. Every two-word phrase of every page is looked at; it is *listed* there if three of its places within WINDOW words
   differ in what stands before or after. Phrases listed on MIN_HOSTS distinct hosts are kept.
2. For these, distinct hosts and distinct neighbours on each side are counted over all pages. A phrase is open on a
   side if its neighbours there are many for its hosts. Runs of kept phrases that begin and end open are stitched.
3. A five-word shingle is stitched if most of it is; a page of little else is a sure case, one mostly without a sure
   other page. Words are weighed by how much more of the sure cases' hosts use them than of the other pages' hosts.
4. A page's shingle is stuffed if its words' weights sum above zero, or if it repeats one or two words; the page is
   a case if stuffed shingles and links are the greater part of it.

Words travel as 64-bit hashes that carry the word's length in their low five bits. Work on a page is done over Arrow
batches in numpy; counts over hosts are Spark aggregates with partial sums before each shuffle. Tables of phrases and
words are sent to the tasks behind a check of their size; beyond it Spark joins them, with the same result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.runtime import materialize, spread

SHINGLE = 5
#: Distinct hosts that list a phrase, or use a word, before either says anything: replicated elsewhere, not in one place.
MIN_HOSTS = 3
#: Words within which three places of a phrase make it listed.
WINDOW = 60
#: Neighbours of a phrase on a side, as a share of its hosts, from which it is open there (and MIN_HOSTS at least).
OPEN_SHARE = 0.1
#: Stitched share, and stitched shingles, of a sure case; share below which a page is surely none.
SURE_SHARE, SURE_SHINGLES, CLEAN_SHARE = 0.9, 15, 0.5
#: Share of stuffed characters from which a page is a case: the greater part of it.
STUFFED_SHARE = 0.5
#: Stuffed shingles and links that a case has at least: less is a short line of tags or a stray heading.
MIN_EVIDENCE = 5
#: Times that a shingle of one or two words stands in its page to be a repeated keyword.
MIN_REPEATS = 3
#: Rows of a table of phrases or words that may be sent to every task (16 bytes each).
LOOKUP_ROWS = 2_000_000
ROWS_AT_ONCE = 2048

URL = r"(?i:https?://|www\.)[^\s()\[\]<>|\"]+|[\p{L}\p{N}_-]+(?:\.[\p{L}\p{N}_-]+)*\.(?i:com|org|net|gov|edu|info|biz|us|io|test|example|invalid)\b(?:/[^\s()\[\]<>|\"]*)?"
LENGTH = 31  # the low bits of a word's hash that hold its length
NUMBER = 32 | 1  # stands for every word with a digit in it
EDGE = 0  # neighbour of a page's first and last word


# --- a page's words ---------------------------------------------------------------------------------------------------

def _hashed(word: str) -> int:
    import xxhash

    if not word or any(c.isdigit() for c in word):
        return NUMBER
    h = xxhash.xxh64_intdigest(word) & ~LENGTH | min(len(word), LENGTH)
    return h - (1 << 64) if h >> 63 else h


def _parsed(text):
    """(links, link characters, flat hashed words, offsets) of an Arrow array of texts."""
    import pyarrow as pa
    import pyarrow.compute as pc

    t = pc.replace_substring_regex(text, r"[\x{200b}\x{200c}\x{200d}\x{00ad}\x{feff}\x01]", "")
    marked = pc.replace_substring_regex(t, URL, "\x01")
    links = pc.count_substring(marked, "\x01")
    link_chars = pc.add(pc.subtract(pc.utf8_length(t), pc.utf8_length(marked)), links)
    # hash tags run words together
    apart = pc.replace_substring_regex(marked, r"(\p{Ll})(\p{Lu})", r"\1 \2")
    rest = pc.utf8_lower(pc.if_else(pc.match_substring(t, "#"), apart, marked))
    rest = pc.replace_substring_regex(rest, r"(\p{L})['\x{2019}](\p{L})", r"\1\2")
    split = pc.split_pattern(pc.replace_substring_regex(rest, r"[^\p{L}\p{M}\p{N}]+", " "), " ")
    coded = split.flatten().dictionary_encode()
    names = coded.dictionary.to_pylist()
    ids = coded.indices.to_numpy(zero_copy_only=False)
    hashes = np.array([_hashed(w) for w in names], dtype=np.int64) if names else np.zeros(0, np.int64)
    filled = np.array([w != "" for w in names], dtype=bool) if names else np.zeros(0, bool)
    keep = filled[ids] if len(ids) else np.zeros(0, bool)
    ends = np.concatenate([[0], np.cumsum(keep)])
    offsets = ends[split.offsets.to_numpy() - split.offsets[0].as_py()]
    return pa.array(links), link_chars, hashes[ids][keep] if len(ids) else hashes, offsets


def _each(df: DataFrame, schema: str, work: Callable) -> DataFrame:
    """mapInArrow in slices of bounded rows; `work` takes a record batch and yields record batches."""

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                yield from work(batch.slice(at, ROWS_AT_ONCE))

    return df.mapInArrow(run, schema)


def _pages(documents: DataFrame, doc: str, text: str, url: str) -> DataFrame:
    """(row, doc, host, links, link_chars, words) of every document with text; `row` is the page's own number."""
    host = F.lower(F.regexp_extract(F.col(url), r"://([^/:?#]+)", 1))
    own = F.when(host != "", F.xxhash64(host)).otherwise(F.xxhash64(F.lit("doc"), F.col(doc)))
    rows = spread(documents.where(F.col(text).rlike(r"\S")).select(F.col(doc).alias("doc"), own.alias("host"), F.col(text).alias("text")))
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "doc", "host", "text")

    def work(b):
        import pyarrow as pa

        links, link_chars, flat, offsets = _parsed(b.column(3))
        words = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int64()))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), links.cast(pa.int64()), link_chars.cast(pa.int64()), words], ["row", "doc", "host", "links", "link_chars", "words"])

    kind = documents.select(doc).schema[0].dataType.simpleString()
    return _each(rows, f"row long, doc {kind}, host long, links long, link_chars long, words array<long>", work)


class _Words:
    """The words of a batch of pages as flat arrays: hash, page and position."""

    def __init__(self, column) -> None:
        self.flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        o = column.offsets.to_numpy().astype(np.int64)
        self.start, self.size = o[:-1] - o[0], np.diff(o)
        self.page = np.repeat(np.arange(len(self.size)), self.size)

    def phrases(self):
        """(place, key) of every two-word phrase without a number."""
        f = self.flat
        at = np.flatnonzero((self.page[:-1] == self.page[1:]) & (f[:-1] != NUMBER) & (f[1:] != NUMBER)) if len(f) > 1 else np.zeros(0, np.int64)
        a, b = f[at].astype(np.uint64), f[at + 1].astype(np.uint64) if len(at) else np.zeros(0, np.uint64)
        key = (a * np.uint64(0x9E3779B97F4A7C15)) ^ ((b << np.uint64(31)) | (b >> np.uint64(33))) * np.uint64(0xC2B2AE3D27D4EB4F)
        return at, (key ^ (key >> np.uint64(29))).view(np.int64)

    def neighbours(self, at):
        """The words before and after the phrases at these places."""
        f, p = self.flat, self.page
        n = len(f)
        before, after = np.maximum(at - 1, 0), np.minimum(at + 2, n - 1)
        left = np.where((at > 0) & (p[before] == p[at]), f[before], EDGE)
        right = np.where((at + 2 < n) & (p[after] == p[at]), f[after], EDGE)
        return left, right

    def per_page(self, values) -> np.ndarray:
        return np.bincount(self.page, weights=values, minlength=len(self.size))

    def windows(self):
        """(first word, words) of every shingle; a page of fewer words is one shingle."""
        short = np.flatnonzero((self.size > 0) & (self.size < SHINGLE))
        n = len(self.flat)
        i = np.arange(max(0, n - SHINGLE + 1))
        i = i[self.page[i] == self.page[i + SHINGLE - 1]] if len(i) else i
        return np.concatenate([i, self.start[short]]), np.concatenate([np.full(len(i), SHINGLE), self.size[short]])

    def covered(self, first, count) -> np.ndarray:
        """How many of the shingles each word stands in."""
        n = len(self.flat)
        return np.cumsum(np.bincount(first, minlength=n + 1) - np.bincount(first + count, minlength=n + 1))[:n]


def _sums(values: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values)])
    return total[first + count] - total[first]


# --- phrases by hosts -------------------------------------------------------------------------------------------------

def _listed(w: _Words):
    """(page, key) of the phrases that a page lists, each once."""
    at, key = w.phrases()
    if len(at) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    left, right = w.neighbours(at)
    import pandas as pd

    # three places in a page at least, found by hashing; only these are sorted
    group, _ = pd.factorize(key ^ (w.page[at] + 1) * np.int64(0x2545F4914F6CDD1D))
    often = np.flatnonzero(np.bincount(group)[group] >= 3)
    at, key, left, right = at[often], key[often], left[often], right[often]
    order = np.lexsort((at, key, w.page[at]))
    k, p, x, l, r = key[order], w.page[at][order], at[order], left[order], right[order]
    same = (k[2:] == k[:-2]) & (p[2:] == p[:-2]) & (x[2:] - x[:-2] <= WINDOW)
    vary = (l[1:-1] != l[:-2]) | (l[2:] != l[:-2]) | (r[1:-1] != r[:-2]) | (r[2:] != r[:-2])
    hit = np.flatnonzero(same & vary)
    once = np.ones(len(hit), bool)
    once[1:] = (k[hit[1:]] != k[hit[:-1]]) | (p[hit[1:]] != p[hit[:-1]])
    return p[hit[once]], k[hit[once]]


def listed_phrases(pages: DataFrame, min_hosts: int = MIN_HOSTS) -> DataFrame:
    """(phrase) of the phrases that pages of `min_hosts` distinct hosts list."""

    def work(b):
        import pyarrow as pa

        page, key = _listed(_Words(b.column(1)))
        host = b.column(0).to_numpy(zero_copy_only=False)[page]
        yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(host, pa.int64())], ["phrase", "host"])

    rows = _each(pages.select("host", "words"), "phrase long, host long", work).distinct()
    return rows.groupBy("phrase").count().where(F.col("count") >= min_hosts).select("phrase")


def _table(df: DataFrame, rows: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Keys in order and values of a small (key, value) table, or None if it has more than `rows` rows."""
    if df.count() > rows:
        return None
    t = df.toPandas()
    key, value = t.iloc[:, 0].to_numpy(np.int64), t.iloc[:, 1].to_numpy(float)
    order = np.argsort(key)
    return key[order], value[order]


def _look(table, keys: np.ndarray) -> np.ndarray:
    """Value of each key, 0 without one."""
    known, value = table
    if not len(known) or not len(keys):
        return np.zeros(len(keys))
    i = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[i] == keys, value[i], 0.0)


def _with_values(pages: DataFrame, table: DataFrame, of_phrases: bool, rows: int):
    """(pages, get): `get(batch, words)` gives the table's value of each word, or of the phrase that starts at it.

    A small table is sent to the tasks. A larger one is joined to the exploded words and gathered again by page.
    """
    small = _table(table, rows)
    if small is not None:
        sent = pages.sparkSession.sparkContext.broadcast(small)

        def get(batch, w: _Words) -> np.ndarray:
            if not of_phrases:
                return _look(sent.value, w.flat)
            at, key = w.phrases()
            out = np.zeros(len(w.flat))
            out[at] = _look(sent.value, key)
            return out

        return pages, get

    def keys(b):
        import pyarrow as pa

        w = _Words(b.column(1))
        at, key = w.phrases() if of_phrases else (np.arange(len(w.flat)), w.flat)
        row = b.column(0).to_numpy(zero_copy_only=False)[w.page[at]]
        yield pa.RecordBatch.from_arrays([pa.array(row, pa.int64()), pa.array(at - w.start[w.page[at]], pa.int64()), pa.array(key, pa.int64())], ["row", "at", "key"])

    spread = _each(pages.select("row", "words"), "row long, at long, key long", keys)
    k, v = table.columns
    found = spread.join(table.select(F.col(k).alias("key"), F.col(v).cast("double").alias("value")), "key")
    gathered = found.groupBy("row").agg(F.collect_list("at").alias("at"), F.collect_list("value").alias("value"))

    def get(batch, w: _Words) -> np.ndarray:
        out = np.zeros(len(w.flat))
        at, value = batch.column("at"), batch.column("value")
        given = np.diff(at.offsets.to_numpy())
        out[np.repeat(w.start, given) + at.flatten().to_numpy(zero_copy_only=False)] = value.flatten().to_numpy(zero_copy_only=False)
        return out

    return pages.join(gathered, "row", "left").withColumns({"at": F.coalesce("at", F.array().cast("array<long>")), "value": F.coalesce("value", F.array().cast("array<double>"))}), get


def open_phrases(pages: DataFrame, phrases: DataFrame, rows: int = LOOKUP_ROWS) -> DataFrame:
    """(phrase, open): on which sides a listed phrase is open over all hosts: 1 before, 2 after, 3 both, 0 neither."""
    small = _table(phrases.select("phrase", F.lit(1.0)), rows)
    sent = None if small is None else pages.sparkSession.sparkContext.broadcast(small)

    def work(b):
        import pandas as pd
        import pyarrow as pa

        w = _Words(b.column(1))
        at, key = w.phrases()
        if sent is not None:
            hit = _look(sent.value, key) > 0
            at, key = at[hit], key[hit]
        left, right = w.neighbours(at) if len(at) else (at, at)
        host = b.column(0).to_numpy(zero_copy_only=False)[w.page[at]]
        parts = [pd.DataFrame({"phrase": key, "side": side, "value": v}).drop_duplicates() for side, v in ((0, host), (1, left), (2, right))]
        yield pa.RecordBatch.from_pandas(pd.concat(parts).astype({"phrase": "int64", "side": "int32", "value": "int64"}), preserve_index=False)

    seen = _each(pages.select("host", "words"), "phrase long, side int, value long", work)
    if sent is None:
        seen = seen.join(phrases, "phrase", "left_semi")
    counts = seen.distinct().groupBy("phrase").agg(*[F.count_if(F.col("side") == s).alias(n) for s, n in ((0, "hosts"), (1, "before"), (2, "after"))])
    least = F.greatest(F.lit(float(MIN_HOSTS)), OPEN_SHARE * F.col("hosts"))
    # a phrase closed on both sides may still stand inside a run
    return counts.select("phrase", ((F.col("before") >= least).cast("int") + 2 * (F.col("after") >= least).cast("int") + 4).cast("double").alias("open"))


def _stitched(w: _Words, kept: np.ndarray):
    """(words in stitched shingles, stitched shingles a page): `kept` is 4 plus the open sides of the phrase at a word."""
    n = len(w.flat)
    ok = kept > 0
    here = np.arange(n)
    # runs of kept phrases, a page's last word never starting one
    begins = ok & ~np.concatenate([[False], ok[:-1]]) if n else ok
    ends = ok & ~np.concatenate([ok[1:], [False]]) if n else ok
    start = np.maximum.accumulate(np.where(begins, here, -1)) if n else here
    stop = np.minimum.accumulate(np.where(ends, here, n)[::-1])[::-1] if n else here
    opened = np.maximum.accumulate(np.where(ok & (kept.astype(int) & 1 > 0), here, -1)) if n else here
    closed = np.minimum.accumulate(np.where(ok & (kept.astype(int) & 2 > 0), here, n)[::-1])[::-1] if n else here
    inside = ok & (opened >= start) & (closed <= stop)
    word = inside.copy()
    word[1:] |= inside[:-1]
    first, count = w.windows()
    hit = _sums(word.astype(float), first, count) >= 0.5 * count
    return w.covered(first[hit], count[hit]) > 0, np.bincount(w.page[first[hit]], minlength=len(w.size))


# --- words by hosts ---------------------------------------------------------------------------------------------------

def word_weights(pages: DataFrame, phrases: DataFrame, rows: int = LOOKUP_ROWS) -> DataFrame:
    """(word, weight): log ratio of a word's shares among sure cases and sure other pages, each host damped to a logarithm.

    Empty if no page is a sure case: then nothing is known about words.
    """
    given, get = _with_values(pages, phrases, True, rows)

    def work(b):
        import pandas as pd
        import pyarrow as pa

        w = _Words(b.column("words"))
        stitched, shingles = _stitched(w, get(b, w))
        length = (w.flat & LENGTH).astype(float)
        chars, hit = w.per_page(length), w.per_page(length * stitched)
        links = b.column("link_chars").to_numpy(zero_copy_only=False)
        sure = (hit >= SURE_SHARE * chars) & (shingles >= SURE_SHINGLES)
        clean = ~sure & (hit + links < CLEAN_SHARE * (chars + links))
        t = pd.DataFrame({"word": w.flat, "host": b.column("host").to_numpy(zero_copy_only=False)[w.page], "s": sure[w.page], "o": clean[w.page]})
        t = t[t.s | t.o].groupby(["word", "host"], sort=False).sum().reset_index()
        yield pa.RecordBatch.from_pandas(t.astype({"word": "int64", "host": "int64", "s": "int64", "o": "int64"}), preserve_index=False)

    cols = ["host", "link_chars", "words", *[c for c in ("at", "value") if c in given.columns]]
    seen = _each(given.select(*cols), "word long, host long, s long, o long", work)
    by_host = seen.groupBy("word", "host").agg(F.log2(1 + F.sum("s")).alias("s"), F.log2(1 + F.sum("o")).alias("o"))
    by_word = materialize(by_host.groupBy("word").agg(F.sum("s").alias("s"), F.sum("o").alias("o"), F.count("*").alias("hosts")), "words")
    total = by_word.agg(F.coalesce(F.sum("s"), F.lit(0.0)).alias("s"), F.coalesce(F.sum("o"), F.lit(0.0)).alias("o")).first()
    ratio = F.log((F.col("s") + 0.5) / (total["s"] + 1)) - F.log((F.col("o") + 0.5) / (total["o"] + 1))
    enough = (F.col("hosts") >= MIN_HOSTS) & F.lit(total["s"] > 0)
    return by_word.where(enough).select("word", F.greatest(F.lit(-4.0), F.least(F.lit(4.0), ratio)).alias("weight"))


def _repeated(w: _Words, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Shingles of one or two words, no number among them, that stand MIN_REPEATS times in their page."""
    out, f = np.zeros(len(first), bool), w.flat
    n = len(f) - SHINGLE + 1
    if n <= 0:
        return out
    at = [f[i : n + i] for i in range(SHINGLE)]
    fresh = np.ones(n, np.int8)
    for i in range(1, SHINGLE):
        seen = at[i] == at[0]
        for j in range(1, i):
            seen |= at[i] == at[j]
        fresh += ~seen
    few = fresh <= 2
    for a in at:
        few &= a != NUMBER
    i = np.flatnonzero((count == SHINGLE) & few[np.minimum(first, n - 1)])
    if len(i):
        five = f[first[i][:, None] + np.arange(SHINGLE)]
        _, which, times = np.unique(np.column_stack([w.page[first[i]], five]), axis=0, return_inverse=True, return_counts=True)
        out[i] = times[which.ravel()] >= MIN_REPEATS
    return out


def stuffing_scores(documents: DataFrame, *, doc: str = "doc_id", text: str = "text", url: str = "url", lookup_rows: int = LOOKUP_ROWS) -> DataFrame:
    """(doc, share, evidence, links, listed, repeated) of every document with text: the share of its characters that stand
    in stuffed shingles or links, the number of those, and of links alone; the shares of its words' characters in
    shingles stitched from listed phrases, and in repeated keywords.

    NULL, empty and blank texts have no row. A document without a host counts as a host of its own. Repeated rows are
    scored each. Other columns are ignored. Tables of more than `lookup_rows` phrases or words are joined, not sent.
    An empty table gives an empty result.
    """
    pages = materialize(_pages(documents, doc, text, url), "pages")
    listed = materialize(listed_phrases(pages), "listed")
    phrases = materialize(open_phrases(pages, listed, lookup_rows), "phrases")
    weights = materialize(word_weights(pages, phrases, lookup_rows), "weights")
    given, stitch = _with_values(pages, phrases, True, lookup_rows)
    renamed = {"at": "phrase_at", "value": "phrase_value"}
    joined = "at" in given.columns
    for old, new in renamed.items():
        given = given.withColumnRenamed(old, new)
    given, weigh = _with_values(given, weights, False, lookup_rows)

    def work(b):
        import pyarrow as pa

        w = _Words(b.column("words"))
        kept = stitch(_Renamed(b) if joined else b, w)
        stitched, _ = _stitched(w, kept)
        first, count = w.windows()
        again = _repeated(w, first, count)
        hit = again | (_sums(weigh(b, w), first, count) > 1e-9)
        every = np.maximum(w.covered(first, count), 1)
        length = (w.flat & LENGTH).astype(float)
        chars, links = w.per_page(length), b.column("links").to_numpy(zero_copy_only=False)
        link_chars = b.column("link_chars").to_numpy(zero_copy_only=False)
        part = w.covered(first[hit], count[hit]) / every
        share = (w.per_page(length * part) + link_chars) / np.maximum(chars + link_chars, 1)
        hits = np.bincount(w.page[first[hit]], minlength=len(w.size))
        # the overlapping shingles of a run of words as the disjoint ones it has
        evidence = np.where(hits > 0, -(-(hits + SHINGLE - 1) // SHINGLE), 0) + links
        of = lambda x: w.per_page(length * x) / np.maximum(chars, 1)
        names = ["doc", "share", "evidence", "links", "listed", "repeated"]
        yield pa.RecordBatch.from_arrays([b.column("doc"), pa.array(np.clip(share, 0, 1)), pa.array(evidence, pa.int64()), pa.array(links, pa.int64()), pa.array(of(stitched)), pa.array(of(w.covered(first[again], count[again]) / every))], names)

    kind = pages.schema["doc"].dataType.simpleString()
    return _each(given.drop("host", "row"), f"doc {kind}, share double, evidence long, links long, listed double, repeated double", work)


class _Renamed:
    """A batch whose phrase columns stand under the names that the lookup reads."""

    def __init__(self, batch) -> None:
        self.batch = batch

    def column(self, name: str):
        return self.batch.column("phrase_" + name)


def stuffed_pages(documents: DataFrame, *, share: float = STUFFED_SHARE, evidence: int = MIN_EVIDENCE, **columns) -> DataFrame:
    """(doc) of the documents of which at least `share` is stuffed, with at least `evidence` stuffed shingles and links."""
    return stuffing_scores(documents, **columns).where((F.col("share") >= share) & (F.col("evidence") >= evidence)).select("doc")
