"""Evaluation texts that leak into training text, by suffix arrays over the training side.

Documents are cut into shards of whole texts where they are read.  Each shard gets a suffix array over
its words; every suffix of every test item is binary-searched in it, and its neighbours there give the
longest verbatim match.  Where that is long enough to be part of a leak, the suffixes around it give all
places.  Matches of one document and item are leaks by either of two rules:

* a passage of at least ``PASSAGE`` words of the item (the whole item, if it has fewer) stands in the
  document such that ``SHARE`` of all words matched, changed, dropped and added are matched.  Four fifths
  leave so few changes that some run of ``SEED`` words (fewer for items under ``PASSAGE`` words) is
  verbatim; from every such run the passage is aligned exactly to both sides, so none is missed.
* pieces that follow each other on nearly one diagonal, chained over changed, dropped and added words,
  hold enough of the item; this also finds passages that are quoted with insertions.

The corpus is never shuffled.  The test material is split into words by the tasks and sent to every task in
blocks of bounded size, so nothing depends on its being small; a block's broadcast ends with its search.

Words are compared after HTML and JSON escapes are resolved, tags are removed, characters have been
brought to one look, accents and case are dropped, and everything but letters and digits is a gap.

Defined results: null and empty texts hold nothing and leak nothing; repeated rows of either side give
one result row; items without words are never found; items of one to three words are found where they stand
verbatim; items whose identifier is null are not searched; documents whose identifier is null give no row of
``find_leaks``, but ``p7_clean`` removes them; texts are searched in full, a long one being a shard of its own.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hunkmill import workspace
from hunkmill.llm.looks import look

#: A passage of at least this many words of the item counts.
PASSAGE = 20
#: Words in a row that a passage holds verbatim at least: 16 words of 20, or 20 and 5 added ones, leave a run of 4.
SEED = 4
#: Of the words of a passage at least this share stands in the document, in order.
SHARE = 0.8
#: This many words found in order are a leak however thin the chain is around them.
PLENTY = 24
#: Words that may be changed, dropped or added between two verbatim pieces.
GAP = 6
#: A word changed, dropped or added weighs as much as so many words found; so SHARE of all are found where the sum isn't negative.
MISS = 4
#: Words by which a passage may run to one side of a verbatim run: one of 40 words or more holds a shorter one.
REACH = 2 * PASSAGE - 1
#: A passage may be shifted by so many words to one side of a verbatim run: as many may be missed in REACH words.
SHIFT = REACH // MISS + 1
#: Matching places that a task holds at once.
HITS = 4_000_000
SHARD_WORDS = 1_000_000
#: Test words sent to the tasks at once: about 30 MB.
BLOCK_WORDS = 1_000_000

WORD = re.compile(r"[^\W_]+")
# The tags that mark up text.
TAG = re.compile(
    r"</?(?:a|abbr|b|blockquote|br|code|dd|del|details|div|dl|dt|em|font|h[1-6]|hr|i|img|ins|kbd|li|mark|ol|p|pre|q|s|samp|small|"
    r"span|strike|strong|sub|summary|sup|table|tbody|td|th|thead|tr|tt|u|ul|var)(?:\s[^<>]*)?/?>",
    re.I,
)
ESCAPE = re.compile(r"\\(?:u([0-9a-fA-F]{4})|x([0-9a-fA-F]{2})|([nrtbf])|([\"'/`*_#<>~|\[\]{}()!.-]))")
PERCENT = re.compile(r"%(20|0[AaDd]|2[1-9A-Fa-f]|3[A-Fa-f]|60|5[BbDd])")


def _unescape(m: re.Match) -> str:
    code = m[1] or m[2]
    return chr(int(code, 16)) if code else " " if m[3] else m[4]


def words(text: str | None) -> list[str]:
    """The comparable words of a text."""
    if not text:
        return []
    if "&" in text:
        text = html.unescape(html.unescape(text))
    if "\\" in text:
        text = ESCAPE.sub(_unescape, text)
        text = text.encode("utf-16", "surrogatepass").decode("utf-16", "replace") if re.search("[\ud800-\udfff]", text) else text
    if "%" in text:
        text = PERCENT.sub(lambda m: chr(int(m[1], 16)), text)
    if "<" in text:
        text = TAG.sub(" ", text)
    text = look(text).casefold()
    if not text.isascii():
        text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    return WORD.findall(text)


def plain_words(text: str | None) -> list[str]:
    """Runs of ASCII letters and digits in lower case, for texts without markup."""
    return re.findall(r"[a-z0-9]+", text.lower()) if text else []


def seed_of(n: int) -> int:
    """The longest run that any passage of an item of ``n`` words holds verbatim at least."""
    if n >= PASSAGE:
        return SEED
    runs = [-(-m // (m // MISS + 1)) for m in range(1, n + 1) if m // MISS >= n - m]  # m words found, m // MISS missed
    return min([SEED, *runs])


class Items:
    """Test items as numbered words; number 0 stands for any word that no item has."""

    def __init__(self, items: list[tuple[int, list[str]]]):
        self.ids = [i for i, _ in items]
        self.numbers: dict[str, int] = {}
        parts = [np.array([self.numbers.setdefault(w, len(self.numbers) + 1) for w in ws], np.int32) for _, ws in items]
        self.lengths = np.array([len(p) for p in parts], np.int64)
        self.seeds = np.array([seed_of(len(p)) for p in parts], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths + SEED)))[:-1].astype(np.int64)
        # zeros between the items end their suffixes
        self.text = np.zeros(int((self.lengths + SEED).sum()), np.int32)
        for at, part in zip(self.starts, parts, strict=True):
            self.text[at : at + len(part)] = part
        self.owner = np.repeat(np.arange(len(parts)), self.lengths + SEED)
        self.suffixes = np.flatnonzero(self.text)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Places of the suffixes of ``text`` that start with a known word, in order; a 0 ends a suffix.

    Suffixes are ordered by 1, 2, 4, ... words.  Only groups that are still equal and have more words go on.
    """
    known = text > 0
    zeros = np.append(np.flatnonzero(~known), len(text))
    left = zeros[np.searchsorted(zeros, np.arange(len(text)))] - np.arange(len(text))  # words up to the end
    order = np.argsort(text, kind="stable")
    ordered = text[order]
    new = np.ones(len(text), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    rank = np.zeros(len(text) + 1, np.int64)
    first = np.maximum.accumulate(np.where(new, np.arange(len(text)), 0))
    rank[order] = first
    open_, step = order[known[order]], 1
    while len(open_):
        group = rank[open_]
        ahead = np.where(left[open_] > step, rank[np.minimum(open_ + step, len(text))] + 1, 0)
        turn = np.lexsort((ahead, group))
        open_, group, ahead = open_[turn], group[turn], ahead[turn]
        head = np.ones(len(open_), bool)
        head[1:] = group[1:] != group[:-1]
        part = head.copy()
        part[1:] |= ahead[1:] != ahead[:-1]
        at = np.arange(len(open_))
        rank[open_] = group + np.maximum.accumulate(np.where(part, at, 0)) - np.maximum.accumulate(np.where(head, at, 0))
        step *= 2
        starts = np.flatnonzero(part)
        sizes = np.diff(np.append(starts, len(open_)))
        on = (sizes > 1) & (np.maximum.reduceat(left[open_], starts) > step)
        open_ = open_[np.repeat(on, sizes)]
    places = np.flatnonzero(known)
    return places[np.argsort(rank[places], kind="stable")]


def _matched(text: np.ndarray, at: np.ndarray, items: Items, suffix: np.ndarray) -> np.ndarray:
    """Words that the suffixes of the shard ``at`` and of the items have in common from their start on."""
    out = np.zeros(len(suffix), np.int64)
    live = np.flatnonzero((at >= 0) & (at < len(text)))
    while len(live):
        word = text[at[live] + out[live]]
        live = live[(word > 0) & (word == items.text[suffix[live] + out[live]])]
        out[live] += 1
    return out


def longest_matches(text: np.ndarray, array: np.ndarray, items: Items) -> np.ndarray:
    """For each suffix of the items, the words of its longest verbatim match in the shard.

    The match is with the suffix before or behind the place where a binary search would put it.
    """
    suffix = items.suffixes
    low, high = np.zeros(len(suffix), np.int64), np.full(len(suffix), len(array), np.int64)
    best = np.zeros(len(suffix), np.int64)
    while True:
        live = np.flatnonzero(low < high)
        if not len(live):
            return best
        mid = (low[live] + high[live]) // 2
        common = _matched(text, array[mid], items, suffix[live])
        best[live] = np.maximum(best[live], common)  # every neighbour is met on the way
        before = text[array[mid] + common] < items.text[suffix[live] + common]
        low[live] = np.where(before, mid + 1, low[live])
        high[live] = np.where(before, high[live], mid)


def _bound(text: np.ndarray, array: np.ndarray, needles: np.ndarray, sizes: np.ndarray, upper: bool) -> np.ndarray:
    """For each needle (the first of ``SEED`` words a row) the first place in the suffix array that isn't before it."""
    low, high = np.zeros(len(needles), np.int64), np.full(len(needles), len(array), np.int64)
    while (open_ := low < high).any():
        mid = (low + high) // 2
        at = array[np.minimum(mid, len(array) - 1)]
        before, equal = np.zeros(len(needles), bool), np.ones(len(needles), bool)
        for k in range(SEED):
            word, used = text[at + k], k < sizes
            before |= equal & used & (word < needles[:, k])
            equal &= ~used | (word == needles[:, k])
        right = open_ & (before | equal if upper else before)
        low, high = np.where(right, mid + 1, low), np.where(open_ & ~right, mid, high)
    return low


def _hopeful(text: np.ndarray, p: np.ndarray, q: np.ndarray, size: np.ndarray, items: Items, need: np.ndarray) -> np.ndarray:
    """Runs that may be part of a passage: words of the item near the run that stand near their place in the document.

    An upper bound of what an alignment can reach, for all runs at once.
    """
    pad = np.zeros(REACH + SHIFT + 1, np.int32)
    padded, own, off = np.concatenate((pad, text, pad)), np.concatenate((pad, items.text, pad)), len(pad)
    wide = np.arange(REACH + 2 * SHIFT) - SHIFT  # the words of a side and as many more as a passage may be shifted

    def side(first_q: np.ndarray, first_p: np.ndarray, way: int) -> np.ndarray:
        word = own[first_q[:, None] + way * np.arange(REACH) + off]
        near = padded[np.clip(first_p[:, None] + way * wide + off, 0, len(padded) - 1)]
        seen = np.zeros(word.shape, bool)
        for shift in range(2 * SHIFT + 1):
            seen |= word == near[:, shift : shift + REACH]
        gain = np.where(seen, np.int32(1), np.int32(-MISS))
        gain[np.logical_or.accumulate(word == 0, axis=1)] = -(10**6)  # behind the item's end
        return np.concatenate((np.zeros((len(word), 1), np.int32), np.cumsum(gain, axis=1, dtype=np.int32)), axis=1)

    out = np.zeros(len(p), bool)
    for a in range(0, len(p), 20_000):
        cut = slice(a, a + 20_000)
        right, left = side(q[cut] + size[cut], p[cut] + size[cut], 1), side(q[cut] - 1, p[cut] - 1, -1)
        ahead = np.maximum.accumulate(left[:, ::-1], axis=1)[:, ::-1]  # the best with so many words to the left or more
        lack = np.clip(need[cut, None] - size[cut, None] - np.arange(REACH + 1)[None, :], 0, REACH)
        out[cut] = (right + np.take_along_axis(ahead, lack, axis=1) + size[cut, None]).max(axis=1) >= 0
    return out


def _extend(doc: list[int], item: list[int], most: int) -> list[int]:
    """Best alignment of the first 0, 1, 2, ... words of ``item`` with a start of ``doc``.

    In thousands, one for each word found and minus ``MISS`` for each one missed; the rest counts the words found.
    """
    lowest = -(10**9)
    row = {c: -1000 * MISS * c for c in range(min(SHIFT, len(doc)) + 1)}
    out = [0]
    for a in range(1, min(most, len(item)) + 1):
        word, fresh, top = item[a - 1], {}, lowest
        for c in range(max(0, a - SHIFT), min(len(doc), a + SHIFT) + 1):
            best = max(row.get(c, lowest), fresh.get(c - 1, lowest)) - 1000 * MISS
            if c:
                best = max(best, row.get(c - 1, lowest) + (1001 if doc[c - 1] == word else -1000 * MISS))
            fresh[c] = best
            top = max(top, best)
        row = fresh
        out.append(top)
        if top < -2000 * REACH:
            break
    return out


def _passage(run: tuple[int, int, int], doc: np.ndarray, item: np.ndarray) -> tuple[int, int] | None:
    """(words found, words of the item) of the longest passage around a verbatim run; null if there is none."""
    p, q, n = run
    need, whole = min(PASSAGE, len(item)), len(item) < PASSAGE
    wide = REACH + SHIFT
    right = _extend(doc[p + n : p + n + wide].tolist(), item[q + n : q + n + REACH].tolist(), REACH)
    left = _extend(doc[max(0, p - wide) : p][::-1].tolist(), item[max(0, q - REACH) : q][::-1].tolist(), REACH)
    best = None
    for a, gain in enumerate(right):
        for b, more in enumerate(left):
            if a + b + n < need or (whole and a + b + n != len(item)):
                continue
            total = gain + more
            found = n + total % 1000
            if total // 1000 + n >= 0 and (best is None or (a + b + n, found) > best[::-1]):
                best = (found, a + b + n)
    return best


def _chain(runs: list[tuple[int, int, int]], doc: np.ndarray, item: np.ndarray) -> tuple[int, int, int]:
    """Best chain of verbatim runs (place in the document, in the item, length): (words found, span, longest run)."""
    best: list[tuple[float, int, int, int]] = []  # score, found, first word of the item, longest
    top = (0, 0, 0)
    for k, (p, q, n) in enumerate(runs):
        mine = (float(n), n, q, n)
        for j in range(k - 1, -1, -1):
            pj, qj, nj = runs[j]
            if p - pj > 4 * PASSAGE + nj:
                break
            dp, dq = p - pj - nj, q - qj - nj
            cut = max(0, -dp, -dq)  # pieces that overlap after a dropped or repeated word
            if cut >= n or max(dp, dq) + cut > GAP:
                continue
            dp, dq = dp + cut, dq + cut
            same = int((doc[p - dp : p] == item[q - dq : q]).sum()) if dp == dq and not cut else 0
            score = best[j][0] + n - cut + same - 0.5 * (max(dp, dq) - same)
            if score > mine[0]:
                mine = (score, best[j][1] + n - cut + same, best[j][2], max(best[j][3], n))
        best.append(mine)
        top = max(top, (mine[1], q + n - mine[2], mine[3]))
    return top


def _leaks(shard: list[tuple[tuple, list[str]]], items: Items, only: int | None = None) -> Iterator[tuple[tuple, int, int, int, int]]:
    """(document, item, words found, words spanned, longest verbatim run) of the leaks in a shard."""
    numbers = items.numbers
    lengths = np.fromiter((len(ws) for _, ws in shard), np.int64, len(shard))
    starts = np.concatenate(([0], np.cumsum(lengths + SEED)))[:-1].astype(np.int64)
    text = np.zeros(int((lengths + SEED).sum()), np.int32)
    for (_, ws), at in zip(shard, starts, strict=True):
        text[at : at + len(ws)] = [numbers.get(w, 0) for w in ws]
    array = suffix_array(text)
    if not len(array) or not len(items.suffixes):
        return
    owner = items.owner[items.suffixes]
    seed = items.seeds[owner]
    long_enough = longest_matches(text, array, items) >= seed
    if only is not None:
        long_enough &= owner == only
    suffixes, owner, seed = items.suffixes[long_enough], owner[long_enough], seed[long_enough]
    if not len(suffixes):
        return
    needles = np.stack([np.where(k < seed, items.text[suffixes + k], -1) for k in range(SEED)], axis=1)
    distinct, back = np.unique(needles, axis=0, return_inverse=True)
    low, high = (_bound(text, array, distinct, (distinct >= 0).sum(axis=1), upper)[back.reshape(-1)] for upper in (False, True))
    many = high - low
    # whole items at a time, as many as the task may hold
    heads = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    per_item, ends, begin = np.add.reduceat(many, heads), np.append(heads[1:], len(owner)), 0
    while begin < len(heads):
        stop, sum_ = begin, 0
        while stop < len(heads) and (stop == begin or sum_ + per_item[stop] <= HITS):
            sum_ += per_item[stop]
            stop += 1
        if sum_ > HITS and len(shard) > 1:  # one item with very many places: fewer documents at a time
            for half in (shard[: len(shard) // 2], shard[len(shard) // 2 :]):
                yield from _leaks(half, items, int(owner[heads[begin]]))
        else:
            cut = slice(heads[begin], ends[stop - 1])
            hit = array[np.repeat(low[cut], many[cut]) + np.arange(sum_) - np.repeat(np.cumsum(many[cut]) - many[cut], many[cut])]
            for d, i, *rest in _judge(text, starts, lengths, items, hit, np.repeat(suffixes[cut], many[cut])):
                yield shard[d][0], items.ids[i], *rest
        begin = stop


def _judge(text: np.ndarray, starts: np.ndarray, lengths: np.ndarray, items: Items, p: np.ndarray, q: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
    """(number of the document, of the item, words found, words spanned, longest run) of the leaks among matching places."""
    doc, item = np.searchsorted(starts, p, side="right") - 1, items.owner[q]
    order = np.lexsort((p, p - q, item, doc))
    doc, item, p, q = doc[order], item[order], p[order], q[order]
    # runs of matches that follow word by word
    new = np.ones(len(p), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (p[1:] - q[1:] != p[:-1] - q[:-1]) | (p[1:] != p[:-1] + 1)
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(p))) + items.seeds[item[first]] - 1
    rp, rq, rd, ri = p[first], q[first], doc[first], item[first]
    group = np.ones(len(first), bool)
    group[1:] = (rd[1:] != rd[:-1]) | (ri[1:] != ri[:-1])
    heads = np.flatnonzero(group)
    ends = np.append(heads[1:], len(first))
    hope = _hopeful(text, rp, rq, size, items, np.minimum(PASSAGE, items.lengths[ri]))
    # a chain needs half a passage in verbatim runs
    chained = (np.add.reduceat(size, heads) >= PASSAGE // 2) & (items.lengths[ri[heads]] >= PASSAGE)
    for h in np.flatnonzero(chained | np.logical_or.reduceat(hope, heads)):
        a, b = heads[h], ends[h]
        d, i = int(rd[a]), int(ri[a])
        at, own = int(starts[d]), int(items.starts[i])
        runs = list(zip((rp[a:b] - at).tolist(), (rq[a:b] - own).tolist(), size[a:b].tolist(), strict=True))
        words_, whole = text[at : at + int(lengths[d])], items.text[own : own + int(items.lengths[i])]
        longest = int(size[a:b].max())
        hits = [x for run, may in zip(runs, hope[a:b], strict=True) if may and (x := _passage(run, words_, whole))]
        if chained[h]:
            found, span, _ = _chain(sorted(runs), words_, whole)
            if found >= SHARE * PASSAGE and (found >= SHARE * span or found >= PLENTY):
                hits.append((found, span))
        if hits:
            yield d, i, *max(hits), longest


FOUND = "doc_id bigint, nameless string, item_id bigint, found int, span int, longest int"
Words = Callable[[str | None], list[str]]


def _searched(batches: Iterator[pa.RecordBatch], shared, split: Words) -> Iterator[pa.RecordBatch]:
    items: Items = shared.value
    shard: list[tuple[tuple, list[str]]] = []
    size = 0

    def flush() -> pa.RecordBatch:
        rows = [(*doc, *rest) for doc, *rest in _leaks(shard, items)] if shard else []
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
        names = [f.split()[0] for f in FOUND.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    for batch in batches:
        for ident, nameless, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "nameless", "text")), strict=True):
            ws = split(text)
            shard.append(((ident, nameless), ws))
            size += len(ws) + SEED
            if size >= SHARD_WORDS:
                yield flush()
                shard, size = [], 0
    yield flush()


def _worded(batches: Iterator[pa.RecordBatch], split: Words) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        listed = [split(t) for t in batch.column("item_text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(listed, pa.list_(pa.string()))], names=["item_id", "words"])


def in_blocks(told: DataFrame) -> tuple[DataFrame, int]:
    """The items (item_id, words) with a ``block``, and the number of blocks; none has more than ``BLOCK_WORDS`` words.

    An item with more words than that is a block of its own.
    """
    total = told.agg(F.sum(F.size("words")).alias("n")).first().n or 0
    blocks = 1 if total <= BLOCK_WORDS else -(-2 * total // BLOCK_WORDS)
    while True:
        placed = told.withColumn("block", F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks)))
        sizes = placed.groupBy("block").agg(F.sum(F.size("words")).alias("n"), F.count("*").alias("items"))
        if sizes.where((F.col("n") > BLOCK_WORDS) & (F.col("items") > 1)).isEmpty():
            return placed, blocks
        blocks *= 2


def search(documents: DataFrame, items: DataFrame, split: Words = words) -> DataFrame:
    """(doc_id, nameless, item_id, found, span, longest) of every document and item that leaked into it.

    A document without an identifier has the fingerprint of its text in ``nameless``.
    """
    spark = documents.sparkSession
    slim = items.where("item_id is not null").select("item_id", "item_text").distinct()
    told = workspace.keep(slim.mapInArrow(lambda it: _worded(it, split), "item_id bigint, words array<string>").distinct(), "items")
    placed, blocks = in_blocks(told)
    texts = documents.where("text <> ''").select("doc_id", F.when(F.col("doc_id").isNull(), F.md5("text")).alias("nameless"), "text")
    found: DataFrame | None = None
    for block in range(blocks):
        rows = placed.where(F.col("block") == block).select("item_id", "words").collect()
        if not rows and blocks > 1:
            continue
        shared = spark.sparkContext.broadcast(Items([(r.item_id, r.words) for r in rows]))
        part = workspace.keep(texts.mapInArrow(lambda it, shared=shared: _searched(it, shared, split), FOUND), "leaks")
        shared.destroy()
        found = part if found is None else found.unionByName(part)
    best = F.max(F.struct("found", "span")).alias("best")
    assert found is not None
    grouped = found.groupBy("doc_id", "nameless", "item_id").agg(best, F.max("longest").alias("longest"))
    return grouped.select("doc_id", "nameless", "item_id", "best.*", "longest")


def find_leaks(documents: DataFrame, items: DataFrame, split: Words = words) -> DataFrame:
    """(doc_id, item_id, found, span, longest) of every document with an identifier and item that leaked into it."""
    return search(documents, items, split).where("doc_id is not null").drop("nameless")


def _load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(workspace.load(spark, sf_dir, "documents"), workspace.load(spark, sf_dir, "eval_items"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, item_id): the documents that hold an item or a passage of it."""
    return _load(spark, sf_dir).select("doc_id", "item_id")


def p7_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_id, documents, longest): in how many documents each item leaked, and its longest verbatim run."""
    return _load(spark, sf_dir).groupBy("item_id").agg(F.count("*").alias("documents"), F.max("longest").alias("longest"))


def without_leaks(documents: DataFrame, items: DataFrame) -> DataFrame:
    """The documents into which nothing leaked; those without an identifier are told apart by their text."""
    gone = workspace.keep(search(documents, items).select("doc_id", "nameless").distinct(), "leaky")
    named = documents.withColumn("_text", F.when(F.col("doc_id").isNull(), F.md5("text")))
    kept = named.join(gone.where("doc_id is not null").select("doc_id"), "doc_id", "left_anti")
    nameless = gone.where("nameless is not null").select(F.col("nameless").alias("_text"))
    return kept.join(nameless, "_text", "left_anti").select(*documents.columns)


def p7_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id): the documents that stay once those with leaks are removed."""
    documents = workspace.load(spark, sf_dir, "documents").select("doc_id", "text")
    return without_leaks(documents, workspace.load(spark, sf_dir, "eval_items")).select("doc_id")


def p7_verbatim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, item_id): twenty words of the item in a row stand in the document, as plain words."""
    found = find_leaks(workspace.load(spark, sf_dir, "documents"), workspace.load(spark, sf_dir, "eval_items"), plain_words)
    return found.where(F.col("longest") >= PASSAGE).select("doc_id", "item_id")


VERBATIM_SQL = r"""with w as (select doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') as w from documents where doc_id is not null and text is not null),
i as (select item_id, regexp_extract_all(lower(item_text), '[a-z0-9]+') as w from eval_items),
d as (select distinct doc_id, hash(list_slice(w, k, k + 19)) as h, list_slice(w, k, k + 19) as g from (select doc_id, w, unnest(range(1, len(w) - 18)) as k from w)),
t as (select distinct item_id, hash(list_slice(w, k, k + 19)) as h, list_slice(w, k, k + 19) as g from (select item_id, w, unnest(range(1, len(w) - 18)) as k from i))
select distinct doc_id, item_id from d join t on d.h = t.h and d.g = t.g
"""
