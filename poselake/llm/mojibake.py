"""Text decoded with the wrong character encoding: found and restored by EM over code-page ciphers."""

from __future__ import annotations

import json
import math
import re
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written

#: Code pages in which garbled text is shown, and in which its bytes were meant.
SHOWN = ("cp1252", "cp1250", "cp1251", "iso8859_2", "mac_roman", "cp437", "cp850", "koi8_r", "cp866", "cp1253", "cp1254")
MEANT = ("cp1252", "cp1250", "cp1251", "cp1253", "cp1255", "iso8859_2", "iso8859_5", "mac_roman", "cp437", "cp850", "koi8_r", "cp866", "euc_jp", "shift_jis", "gbk", "big5", "euc_kr")
MULTIBYTE = {"utf_8", "utf_8 twice", "euc_jp", "shift_jis", "gbk", "big5", "euc_kr"}
#: UTF-8 shown byte by byte, the bytes 80 to 9F left out.
STRIPPED = ("latin_1", "utf_8")
#: Buckets of the hashed n-gram counts; it bounds what is gathered and broadcast.
BUCKETS = 1 << 22
#: Buckets that aren't empty, and their counts: what is sent around.
Counts = tuple[np.ndarray, np.ndarray]
_RUN = re.compile(r"[^\x00-\x7f]+")
_BACKOFF = 2.0


# Code pages -----------------------------------------------------------------------------------------
@lru_cache(None)
def _byte_of(page: str) -> dict[str, int]:
    """Character to byte of a single-byte page; bytes the page leaves undefined are shown as C1 controls."""
    table = {}
    for b in range(128, 256):
        try:
            table[bytes([b]).decode(page)] = b
        except UnicodeDecodeError:
            pass
    used = set(table.values())
    for b in range(128, 160):  # decoders that pass undefined (or all) high controls through
        if b not in used or page == "cp1252":
            table.setdefault(chr(b), b)
    return table


@lru_cache(None)
def cipher(shown: str, meant: str) -> dict[int, str]:
    """Substitution table, for str.translate, of a swap between single-byte pages: shown to meant."""
    out = {}
    for char, b in _byte_of(shown).items():
        try:
            letter = bytes([b]).decode(meant)
        except UnicodeDecodeError:
            continue
        if letter != char and letter >= "\xa0":
            out[ord(char)] = letter
    return out


def _bytes(run: str, shown: str) -> bytes | None:
    table = _byte_of(shown)
    try:
        return bytes([table[c] for c in run])
    except KeyError:
        return None


@lru_cache(None)
def _shows(page: str) -> frozenset[str]:
    return frozenset(_byte_of(page))


def swaps() -> list[tuple[str, str]]:
    """All (shown, meant) pairs tried; the last two are single bytes read as UTF-8, and UTF-8 whose high controls were dropped."""
    return [(s, m) for s in SHOWN for m in ("utf_8", "utf_8 twice", *MEANT) if s != m] + [("utf_8", "cp1252"), STRIPPED]


def restore(run: str, shown: str, meant: str) -> str | None:
    """The non-ASCII ``run`` as it was meant; None if the swap can't have made it."""
    if shown == "utf_8":  # single bytes that happened to be valid UTF-8
        try:
            return run.encode().decode(meant)
        except UnicodeDecodeError:
            return None
    if meant not in MULTIBYTE:
        table = cipher(shown, meant)
        out = run.translate(table)
        return out if out != run and all(ord(c) in table or c in _byte_of(meant) for c in run) else None
    table, pieces, at, some = _byte_of(shown), [], 0, False
    while at < len(run):  # stretches that the page can show; others stand as they are
        end = at
        while end < len(run) and run[end] in table:
            end += 1
        if end - at > 1:
            back = _decoded(bytes([table[c] for c in run[at:end]]), shown, meant)
            if back is None:
                return None
            pieces.append(back)
            some = True
        else:
            end = max(end, at + 1)
            pieces.append(run[at:end])
        at = end
    return "".join(pieces) if some else None


def _decoded(data: bytes, shown: str, meant: str) -> str | None:
    try:
        out = data.decode("utf_8" if meant == "utf_8 twice" else meant)
        if meant == "utf_8 twice":
            again = _bytes(out, shown)
            if again is None or len(again) < 2:
                return None
            out = again.decode("utf_8")
    except UnicodeDecodeError:
        return _rest_lost(data) if meant == "utf_8" else None
    return out if min(out) >= "\xa0" else None


def _rest_lost(data: bytes) -> str | None:
    """UTF-8 that lost bytes at its ends only: the whole characters between, if they are most of it."""
    a = next((i for i, b in enumerate(data) if b & 0xC0 != 0x80), len(data))
    lead = max((i for i, b in enumerate(data) if b & 0xC0 == 0xC0), default=0)
    for part in (data[a:], data[a:lead]):
        try:
            out = part.decode("utf_8")
        except UnicodeDecodeError:
            continue
        return out if 2 * len(part) > len(data) and min(out) >= "\xa0" else None
    return None


# Language model ---------------------------------------------------------------------------------------
def _fold(text: str) -> str:
    """Digits alike, and the neighbours of a run that may be garbled themselves."""
    return _RUN.sub("\x01", re.sub(r"[0-9]", "0", text))


@lru_cache(100_000)
def _left(text: str) -> str:
    return _fold(text).rjust(2, "\n")[-2:]


@lru_cache(100_000)
def _right(text: str) -> str:
    return _fold(text).ljust(2, "\n")[:2]


def _key(a: int, b: int, c: int) -> int:
    return ((a * 0x9E3779B97F4A7C15 + b * 0xC2B2AE3D27D4EB4F + c * 0x165667B19E3779F9 + 0x27D4EB2F165667C5) & 0xFFFFFFFFFFFFFFFF) >> 42


def _keys(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """:func:`_key` of arrays."""
    a, b, c = (np.asarray(x).astype(np.uint64) for x in (a, b, c))
    with np.errstate(over="ignore"):
        mixed = a * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F) + c * np.uint64(0x165667B19E3779F9) + np.uint64(0x27D4EB2F165667C5)
    return (mixed >> np.uint64(42)).astype(np.int64)


@lru_cache(500_000)
def ngrams(three: str) -> tuple[int, int, int, int, int]:
    """Buckets of the n-grams that end in the last of ``three`` characters."""
    a, b, c = (ord(x) + 2 for x in three)
    return _key(a, b, c), _key(a, b, 0), _key(1, b, c), _key(1, b, 0), _key(1, 1, c)


class Bigrams:
    """log P of a character after the two before it, backing off to one and to none; hashed counts."""

    def __init__(self, counts: Counts):
        self.n = np.zeros(BUCKETS, np.float32)
        self.n[counts[0]] = counts[1]
        counts = self.n
        self.total = float(counts[_key(1, 1, 1)]) + 1.0
        self.known: dict[str, float] = {}
        self.seen: dict[str, bool] = {}
        self._forms: dict[str, str] | None = None

    @property
    def forms(self) -> dict[str, str]:
        """What is left of a character's UTF-8 without the bytes 80 to 9F, to the most frequent such character."""
        if self._forms is None:
            found: dict[str, tuple[float, str]] = {}
            for point in range(0xA1, 0x3000):
                n = float(self.n[_key(1, 1, point + 2)])
                form = "".join(chr(b) for b in chr(point).encode() if not 0x80 <= b < 0xA0)
                if n >= 20 and n > found.get(form, (0.0, ""))[0]:
                    found[form] = (n, chr(point))
            self._forms = {form: char for form, (_, char) in found.items()}
        return self._forms

    def unstripped(self, run: str) -> str | None:
        """``run`` read by :attr:`forms`, the longest first; None if a part is no form."""
        forms, out, at = self.forms, [], 0
        while at < len(run):
            size = next((n for n in (3, 2, 1) if run[at : at + n] in forms), 0)
            if not size:
                return None
            out.append(forms[run[at : at + size]])
            at += size
        return "".join(out)

    def _log(self, three: str) -> float:
        n = self.n
        whole, two_before, two, one_before, one = (float(n[k]) for k in ngrams(three))
        # A character seen in its other case only is rare rather than unheard of.
        other = three[2].swapcase()
        one += 0.05 * float(n[_key(1, 1, ord(other) + 2)]) if len(other) == 1 else 0.0
        p = (one + 0.05) / self.total
        p = (two + _BACKOFF * p) / (one_before + _BACKOFF)
        if len(self.known) > 1_000_000:
            self.known.clear()
        out = self.known[three] = math.log((whole + _BACKOFF * p) / (max(two_before, whole) + _BACKOFF))
        return out

    def score(self, window: str) -> float:
        known, out = self.known, 0.0
        for i in range(2, len(window)):
            three = window[i - 2 : i + 1]
            got = known.get(three)
            out += self._log(three) if got is None else got
        return out

    def follows(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """log P of each code point of ``after`` (columns) following each of ``before`` (rows)."""
        a, b = np.asarray(before, np.int64)[:, None] + 2, np.asarray(after, np.int64)[None, :] + 2
        one = (self.n[_keys(1, 1, b)] + 0.05) / self.total
        two = self.n[_keys(1, a, b)]
        return np.log((two + _BACKOFF * one) / (np.maximum(self.n[_keys(1, a, 0)], two) + _BACKOFF))

    def knows(self, char: str) -> bool:
        """Whether the character, in either case, occurs in text believed clean."""
        got = self.seen.get(char)
        if got is None:
            forms = {c for c in (char, char.lower(), char.upper()) if len(c) == 1}
            got = self.seen[char] = any(self.n[_key(1, 1, ord(c) + 2)] >= 1 for c in forms)
        return got


def windows(text: str):
    """(start, end, left, run, right) of every non-ASCII run, with two characters on each side, digits folded."""
    for m in _RUN.finditer(text):
        a, b = m.span()
        yield a, b, _left(text[a - 2 if a > 1 else 0 : a]), m.group(), _right(text[b : b + 2])


def _count_ngrams(window: str, weight: float, into: dict[int, float]) -> None:
    for i in range(2, len(window)):
        for key in ngrams(window[i - 2 : i + 1]):
            into[key] += weight
    into[_key(1, 1, 1)] += weight * (len(window) - 2)


def candidates(left: str, run: str, right: str, model: Bigrams, pairs) -> list[tuple[int, str, float]]:
    """(index of the swap, restored run, gain in log likelihood) of the swaps that can have made ``run``."""
    raw, seen, out = None, {}, []
    chars, able = set(run), {}
    for k, (shown, meant) in pairs:
        if shown not in able:
            able[shown] = shown in ("utf_8", "latin_1") or not chars.isdisjoint(_shows(shown))
        if (shown, meant) == STRIPPED:
            got = model.unstripped(run)
        elif not able[shown] or (len(run) < 2 and meant in MULTIBYTE):
            continue
        else:
            got = restore(run, shown, meant)
        if got is None:
            continue
        gain = seen.get(got)
        if gain is None:
            if not all(map(model.knows, set(got))):
                gain = -math.inf
            else:
                if raw is None:
                    raw = model.score(left + run + right)
                gain = model.score(left + got + right) - raw
            seen[got] = gain
        if gain > -math.inf:
            out.append((k, got, gain))
    return out


# EM ---------------------------------------------------------------------------------------------------
def _window_rows(text: str, source: str):
    def run(batches):
        for batch in batches:
            seen: Counter = Counter()
            for t, s in zip(batch.column(text).to_pylist(), batch.column(source).to_pylist()):
                if t and not t.isascii():
                    seen.update({(s, left, r, right) for _, _, left, r, right in windows(t)})  # once a document
            if seen:
                keys = list(seen)
                yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in keys], pa.string()) for i in range(4)] + [pa.array(list(seen.values()), pa.int64())], ["source", "left", "run", "right", "n"])

    return run


class Learned:
    """What EM found: language counts, the weight of every swap over all sources, and a table of each source's own.

    ``own``: (source, own) with ``own`` a JSON text: weights by swap, and the bytes of a page learned for the source.
    """

    def __init__(self, counts: Counts, general: dict[int, float], own: DataFrame):
        self.counts, self.general, self.own = counts, general, own


@lru_cache(10_000)
def _own(text: str | None) -> tuple[dict[int, float], dict[int, str] | None]:
    """Weights and the learned page (character to the Latin-1 character of its byte) of a source."""
    got = json.loads(text) if text else {}
    page = got.get("page")
    return {int(k): w for k, w in got.get("weights", {}).items()}, {ord(c): chr(b) for c, b in page.items()} if page else None


def _with_own(df: DataFrame, own: DataFrame, source: str) -> DataFrame:
    """``df`` with its source's ``own``; a null source is one of its own. Spark broadcasts the table if it knows it to be small."""
    named = own.select(F.col("source").alias("__source"), "own")
    return df.join(named, df[source].eqNullSafe(named["__source"]), "left").drop("__source")


def _gather(deltas: DataFrame) -> Counts:
    """Counts summed over all partitions, at most one number per bucket."""
    pdf = deltas.groupBy("bucket").agg(F.sum("w").alias("w")).filter("w <> 0").toPandas()  # bounded by BUCKETS
    return pdf["bucket"].to_numpy(np.int32), pdf["w"].to_numpy(np.float32)


def _language(table: DataFrame) -> Counts:
    """n-gram counts of the windows, each as it stands and as restored by its share of belief."""

    def run(batches):
        for batch in batches:
            into: dict[int, float] = defaultdict(float)
            for left, r, right, n, restored, belief in zip(*(batch.column(c).to_pylist() for c in ("left", "run", "right", "n", "restored", "belief"))):
                if belief < 1:
                    _count_ngrams(left + r + right, n * (1 - belief), into)
                if belief > 0 and restored is not None:
                    _count_ngrams(left + restored + right, n * belief, into)
            yield pa.RecordBatch.from_arrays([pa.array(list(into), pa.int64()), pa.array(list(into.values()), pa.float64())], ["bucket", "w"])

    return _gather(table.mapInArrow(run, "bucket bigint, w double"))


def _first_guess(batches):
    """Runs that read as UTF-8 under some page count by half as they stand, and not yet as restored: what the
    language knows must come from elsewhere, or a coincidence would vouch for itself."""
    utf8 = [p for p in swaps() if p[1] == "utf_8" and p != STRIPPED]
    for batch in batches:
        odd = [len(r) > 1 and any(restore(r, *p) is not None for p in utf8) for r in batch.column("run").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([None] * len(odd), pa.string()), pa.array([0.5 if x else 0.0 for x in odd])], [*batch.schema.names, "restored", "belief"])


def learn(df: DataFrame, text: str = "text", source: str = "source", rounds: int = 4) -> Learned:
    """Expectation-maximization over all documents: which swaps garbled each source, and how the language reads.

    Every non-ASCII run with two characters on each side is a cipher text under an unknown key: one of the listed
    code-page swaps, a page of the source's own, or none. E step: the posterior of each key given the source's weights
    and the bigram model. M step: weights from the posteriors (the share of garbled windows among those a swap can have
    made), and the bigram model recounted from the text as restored. It starts from even odds for runs that read as UTF-8
    under some page, and ends after ``rounds`` or when no weight moves by 0.01; swaps with less than half a window in all
    are left out then. Clean text has no U+FFFD: the posterior of such a window is one. Windows are counted first (once a
    document and text), so the steps run over distinct windows. What the listed swaps don't explain goes to :func:`learned_pages`. The driver holds hashed counts
    of fixed size and one weight a swap; the weights of sources are a table.
    """
    schema = "source string, left string, run string, right string, n bigint"
    found = df.select(F.col(text).alias("t"), F.col(source).cast("string").alias("s")).mapInArrow(_window_rows("t", "s"), schema)
    spark, context = df.sparkSession, df.sparkSession.sparkContext
    # Few bytes but much work a row, so adaptive execution must not pack them into few parts. A window's sources meet in one, which weighs it once.
    parts = max(3 * context.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    table = written(found.groupBy("source", "left", "run", "right").agg(F.sum("n").alias("n")).repartition(parts, "left", "run", "right"))
    full = schema + ", restored string, belief double"
    counts = _language(table.mapInArrow(_first_guess, full))
    general = {k: 0.5 if p[1].startswith("utf_8") and p != STRIPPED else 1e-4 for k, p in enumerate(swaps())}
    own = None
    for _ in range(rounds):
        shared = context.broadcast((counts, general))
        weighted = table.withColumn("own", F.lit(None).cast("string")) if own is None else _with_own(table, own, "source")
        scored = written(weighted.mapInArrow(_expect(shared), full + ", swap int, fits array<int>"))
        shared.destroy()
        counts = _language(scored)
        before, (general, own) = general, _maximize(scored)
        if max((abs(general.get(k, 0.0) - w) for k, w in before.items()), default=0.0) < 0.01:
            break
    pages = learned_pages(scored, counts)
    if pages is not None:
        weights = F.get_json_object("own", "$.weights")
        own = own.withColumnRenamed("source", "_s").join(pages, F.col("_s").eqNullSafe(F.col("source")), "full").select(
            F.coalesce("_s", "source").alias("source"), F.concat(F.lit('{"weights":'), F.coalesce(weights, F.lit("{}")), F.when(F.col("page").isNotNull(), F.concat(F.lit(',"page":'), "page")).otherwise(""), F.lit("}")).alias("own"),
        )
        own = written(own)
    return Learned(counts, general, own)


def _maximize(scored: DataFrame) -> tuple[dict[int, float], DataFrame]:
    """The weights of all swaps, and a table of those of each source, drawn towards the general ones as by 20 more windows."""
    fits = scored.select("source", "n", "swap", "belief", F.explode("fits").alias("k"))
    share = written(fits.groupBy("source", "k").agg(F.sum("n").alias("fit"), F.sum(F.when(F.col("swap") == F.col("k"), F.col("n") * F.col("belief")).otherwise(0.0)).alias("mass")))
    whole = share.groupBy("k").agg(F.sum("mass").alias("mass"), F.sum("fit").alias("fit")).filter("mass >= 0.5")
    whole = whole.select("k", (F.col("mass") / (F.col("fit") + 10.0)).alias("general"))
    general = {r.k: r.general for r in whole.collect()}  # a row for each swap at most
    drawn = share.join(F.broadcast(whole), "k").withColumn("w", (F.col("mass") + 20 * F.col("general")) / (F.col("fit") + 20))
    weights = F.map_from_entries(F.collect_list(F.struct(F.col("k").cast("string").alias("k"), "w")))
    return general, written(drawn.groupBy("source").agg(F.to_json(F.struct(weights.alias("weights"))).alias("own")))


def _odds(weight: float) -> float:
    """Odds before the run is read; even at most, so that the text itself has to speak for a swap."""
    return min(weight / (1.0001 - weight), 1.0)


def _expect(shared):
    def run(batches):
        counts, general = shared.value
        model, pairs, weighed = Bigrams(counts), swaps(), {}
        active = [(k, pairs[k]) for k in general]
        for batch in batches:
            restored, belief, swap, fits = [], [], [], []
            for own, left, r, right in zip(*(batch.column(c).to_pylist() for c in ("own", "left", "run", "right"))):
                weights = _own(own)[0]
                best, odds = (None, None), 0.0
                able = weighed.get((left, r, right))
                if able is None:
                    if len(weighed) > 200_000:
                        weighed.clear()
                    able = weighed[left, r, right] = candidates(left, r, right, model, active)
                fits.append([k for k, _, _ in able])
                for k, got, gain in able:
                    o = _odds(weights.get(k, general[k])) * math.exp(min(gain, 600))
                    odds += o
                    if best[0] is None or o > best[0]:
                        best = (o, (k, got))
                p = 1.0 if "\ufffd" in r else odds / (odds + 1)
                keep = p > 0.01 and best[1] is not None
                restored.append(best[1][1] if keep else None)
                swap.append(best[1][0] if keep else None)
                belief.append(p if p > 0.01 else 0.0)
            columns = [batch.column(c) for c in ("source", "left", "run", "right", "n")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(restored, pa.string()), pa.array(belief, pa.float64()), pa.array(swap, pa.int32()), pa.array(fits, pa.list_(pa.int32()))], ["source", "left", "run", "right", "n", "restored", "belief", "swap", "fits"])

    return run


# Pages learned from the text ---------------------------------------------------------------------------
#: What a page has to show for itself: windows of a lead character, characters that follow it, nats beyond the cost of its key.
LEAD_WINDOWS, LEAD_FOLLOWERS, KEY_GAIN = 6, 3, 20.0
#: Windows of one source that a task reads in a step of EM.
PART = 20_000


def learned_pages(scored: DataFrame, counts: Counts, rounds: int = 6) -> DataFrame | None:
    """(source, page): for sources whose text shows UTF-8 in a page that isn't listed, the page as learned; None if there is none.

    Such text is a substitution cipher: every byte from 80 on stands as one character, the same throughout a source. The
    leading bytes of a script are few, so a character that stands at even places of runs only, with several others
    behind it, may be one. Runs made of pairs under such leads are cipher texts; hidden below are letters of two bytes, which
    follow each other and their neighbours as the bigram model says. EM (forward-backward, Baum-Welch): the posterior of every
    letter at every place, then P(character | byte) from the expected counts, started from the listed pages as a prior.
    Runs with characters of three bytes are not read by it.
    A page is kept if its characters have one byte each, and what its reading gains in likelihood next to letters outweighs
    the cost of its key, log 64 for every character: a unit behind a number, such as Å³, is no cipher text. Rows per source are dealt to tasks; expected counts are summed up by character and byte.
    """
    spark = scored.sparkSession
    windows = scored.filter((F.col("belief") < 0.5) & (F.length("run") % 2 == 0) & (F.length("run") > 0)).select("source", "left", "run", "right", "n")
    places = windows.mapInArrow(_places, "source string, char string, even bigint, odd bigint, follower string")
    places = places.groupBy("source", "char", "follower").agg(F.sum("even").alias("even"), F.sum("odd").alias("odd"))
    leads = places.groupBy("source", "char").agg(F.sum("even").alias("even"), F.sum("odd").alias("odd"), F.count(F.when(F.col("even") > 0, F.col("follower"))).alias("followers"))
    leads = leads.filter((F.col("even") >= LEAD_WINDOWS) & (F.col("odd") * 20 <= F.col("even")) & (F.col("followers") >= LEAD_FOLLOWERS))
    leads = written(leads.groupBy("source").agg(F.concat_ws("", F.sort_array(F.collect_list("char"))).alias("leads")))
    if not leads.limit(1).count():
        return None
    named = leads.withColumnRenamed("source", "_s")
    even = F.transform(F.sequence(F.lit(0), F.floor(F.length("run") / 2).cast("int") - 1), lambda i: F.substr("run", 2 * i + 1, F.lit(1)))
    cipher_texts = windows.join(named, windows["source"].eqNullSafe(named["_s"])).filter(F.forall(even, lambda c: F.contains(F.col("leads"), c)))
    cipher_texts = cipher_texts.select(F.to_json(F.struct("source")).alias("name"), "source", "left", "run", "right", "n")
    size = cipher_texts.groupBy("name").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("slots"))
    cipher_texts = written(cipher_texts.join(size, "name").withColumn("slot", F.pmod(F.xxhash64("left", "run", "right"), "slots").cast("int")))
    slots = written(cipher_texts.select("name", "slot").distinct())
    shared = spark.sparkContext.broadcast(counts)
    theta = spark.createDataFrame([], "name string, char string, byte int, n double")
    schema = "name string, char string, byte int, n double"

    def step(each, schema: str) -> DataFrame:
        held = slots.join(theta, "name", "left")
        return cipher_texts.groupBy("name", "slot").cogroup(held.groupBy("name", "slot")).applyInArrow(each, schema)

    for _ in range(rounds):
        theta = written(step(_posteriors(shared), schema).groupBy("name", "char", "byte").agg(F.sum("n").alias("n")))
    gains = step(_gains(shared), "name string, page string, gain double, read double, n double").groupBy("name", "page").agg(F.sum("gain").alias("gain"), F.sum("read").alias("read"), F.sum("n").alias("n"))
    key = F.size(F.map_keys(F.from_json("page", "map<string,int>"))) * math.log(64)
    return written(gains.filter((F.col("gain") > key + KEY_GAIN) & (2 * F.col("read") > F.col("n"))).select(F.get_json_object("name", "$.source").alias("source"), "page"))


def _places(batches):
    """How often each character stands at even and odd places of runs, by the character behind it."""
    for batch in batches:
        seen: dict[tuple, list[int]] = defaultdict(lambda: [0, 0])
        for s, r in zip(batch.column("source").to_pylist(), batch.column("run").to_pylist()):
            for i, c in enumerate(r):
                seen[s, c, r[i + 1] if i % 2 == 0 else ""][i % 2] += 1
        keys, n = list(seen), list(seen.values())
        columns = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([x[0] for x in n], pa.int64()), pa.array([x[1] for x in n], pa.int64()), pa.array([k[2] for k in keys], pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["source", "char", "even", "odd", "follower"])


class Page:
    """P(character | byte) of one source, and the letters that pairs of characters may hide."""

    def __init__(self, model: Bigrams, chars: list[str], theta: list[tuple[str, int, float]]):
        points = np.arange(0xA0, 0x800)
        self.points = points[model.n[_keys(1, 1, points + 2)] >= 3]
        self.lead, self.rest = 0xC0 | self.points >> 6, 0x80 | self.points & 0x3F
        self.at = {c: i for i, c in enumerate(chars)}
        n = np.full((len(chars), 256), 1e-3)
        if theta:
            for c, b, x in theta:
                if c in self.at:
                    n[self.at[c], b] += x
        else:  # the listed pages as a prior
            n += 0.1
            for shown in SHOWN:
                for c, b in _byte_of(shown).items():
                    if c in self.at:
                        n[self.at[c], b] += 0.1
        self.log = np.log(n / n.sum(0, keepdims=True))
        self.model, self.step = model, model.follows(self.points, self.points)

    def emits(self, run: str) -> np.ndarray:
        """log P of each pair of the run (rows) under each letter (columns)."""
        at = [self.at[c] for c in run]
        return np.stack([self.log[a, self.lead] + self.log[b, self.rest] for a, b in zip(at[::2], at[1::2])])

    def posterior(self, left: str, run: str, right: str) -> np.ndarray:
        """P of each letter (columns) at each pair (rows): forward and backward."""
        emit = self.emits(run)
        start = self.model.follows([ord(left[-1])], self.points)[0]
        end = self.model.follows(self.points, [ord(right[0])])[:, 0]
        forward, backward = [start + emit[0]], [end]
        for e in emit[1:]:
            forward.append(_added(forward[-1][:, None] + self.step, 0) + e)
        for e in emit[:0:-1]:
            backward.append(_added(self.step + (backward[-1] + e)[None, :], 1))
        both = np.stack(forward) + np.stack(backward[::-1])
        both = np.exp(both - both.max(1, keepdims=True))
        return both / both.sum(1, keepdims=True)


def _added(logs: np.ndarray, axis: int) -> np.ndarray:
    top = logs.max(axis, keepdims=True)
    return np.log(np.exp(logs - top).sum(axis)) + top.squeeze(axis)


def _texts(left: pa.Table) -> list[tuple]:
    return list(zip(*(left.column(c).to_pylist() for c in ("left", "run", "right", "n"))))


def _theta(right: pa.Table) -> list[tuple[str, int, float]]:
    return [(c, b, n) for c, b, n in zip(*(right.column(x).to_pylist() for x in ("char", "byte", "n"))) if c is not None]


@lru_cache(1)
def _model(shared) -> Bigrams:
    return Bigrams(shared.value)


def _posteriors(shared):
    def each(left: pa.Table, right: pa.Table) -> pa.Table:
        texts = _texts(left)
        chars = sorted({c for _, r, _, _ in texts for c in r} | {c for c, _, _ in _theta(right)})
        page = Page(_model(shared), chars, _theta(right))
        n = np.zeros((len(chars), 256))
        for before, r, after, weight in texts:
            for a, b, p in zip(r[::2], r[1::2], page.posterior(before, r, after)):
                np.add.at(n[page.at[a]], page.lead, weight * p)
                np.add.at(n[page.at[b]], page.rest, weight * p)
        i, j = np.nonzero(n > 1e-6)
        name = left.column("name")[0].as_py() if texts else None
        return pa.table({"name": pa.array([name] * len(i), pa.string()), "char": pa.array([chars[x] for x in i], pa.string()), "byte": pa.array(j.astype(np.int32)), "n": pa.array(n[i, j])})

    return each


def _gains(shared):
    def each(left: pa.Table, right: pa.Table) -> pa.Table:
        model, texts = _model(shared), _texts(left)
        total, best = defaultdict(float), {}
        for c, b, n in _theta(right):
            total[c] += n
            if n > best.get(c, (0.0, 0))[0]:
                best[c] = (n, b)
        page, taken = {}, {}
        for c, (n, b) in sorted(best.items(), key=lambda x: (-x[1][0], x[0])):  # one byte a character, one character a byte
            if n >= 0.8 * total[c] and b not in taken:
                page[c] = taken[b] = b
        table = {ord(c): chr(b) for c, b in page.items()}
        gain = read = weight = 0.0
        for before, r, after, n in texts:
            got = translated(r, table)
            weight += n
            if got is not None and all(map(model.knows, set(got))):
                gain += 0 if not (len(got) > 1 or before[-1].isalpha() or after[0].isalpha()) else n * (model.score(before + got + after) - model.score(before + r + after))
                read += n
        some = bool(texts) and len(page) > LEAD_FOLLOWERS
        name = [left.column("name")[0].as_py()] if some else []
        text = [json.dumps(dict(sorted(page.items())), ensure_ascii=False)] if some else []
        return pa.table({"name": pa.array(name, pa.string()), "page": pa.array(text, pa.string()), **{k: pa.array([v] if some else [], pa.float64()) for k, v in (("gain", gain), ("read", read), ("n", weight))}})

    return each


def translated(run: str, page: dict[int, str]) -> str | None:
    """``run`` read through a learned page: characters to bytes by translate(), bytes as UTF-8."""
    try:
        out = run.translate(page).encode("latin_1").decode("utf_8") if all(ord(c) in page for c in run) else None
    except UnicodeError:
        return None
    return out if out and min(out) >= "\xa0" else None


# Application -------------------------------------------------------------------------------------------
class Judge:
    """Decides on documents with what was learned; remembers windows already weighed."""

    #: Index of the page learned for a source, behind all listed swaps; its odds are even.
    OWN = -1

    def __init__(self, counts: Counts, general: dict[int, float], threshold: float):
        self.model, self.general, self.threshold = Bigrams(counts), general, threshold
        pairs = swaps()
        self.active = [(k, pairs[k]) for k in general]
        self.known: dict[tuple, list[tuple[int, str, float, float]]] = {}

    def weigh(self, left: str, run: str, right: str, own: str | None) -> list[tuple[int, str, float, float]]:
        """(swap, restored, gain, evidence of garbled-or-not) of each swap that can have made the run."""
        page = _own(own)[1]
        key = (left, run, right, own if page else None)
        got = self.known.get(key)
        if got is None:
            if len(self.known) > 500_000:
                self.known.clear()
            able = candidates(left, run, right, self.model, self.active)
            back = translated(run, page) if page else None
            if back is not None and all(map(self.model.knows, set(back))):
                able.append((self.OWN, back, self.model.score(left + back + right) - self.model.score(left + run + right)))
            got = self.known[key] = [(k, back, gain, math.log(0.5 * math.exp(min(gain, 600)) + 0.5)) for k, back, gain in able]
        return got

    def judge(self, text: str, own: str | None) -> tuple[bool, str | None, int, int]:
        """(garbled, restored text, runs restored, characters lost)."""
        lost = text.count("\ufffd")
        evidence: dict[int, float] = {}
        likely = False
        for key in {(left, run, right) for _, _, left, run, right in windows(text)}:
            for k, _, gain, e in self.weigh(*key, own):
                evidence[k] = evidence.get(k, 0.0) + e
                likely = likely or gain > 0
        weights = _own(own)[0]
        odds = lambda k: 0.0 if k == self.OWN else math.log(max(_odds(weights.get(k, self.general[k])), 1e-9))
        chosen = {k for k, e in evidence.items() if e + odds(k) > self.threshold} if likely else ()
        if not chosen:
            return bool(lost), None, 0, lost
        pieces, at, n = [], 0, 0
        for a, b, *key in windows(text):
            best = max(((gain, back) for k, back, gain, _ in self.weigh(*key, own) if k in chosen), default=(0.0, None))
            if best[0] > 0:
                pieces += [text[at:a], best[1]]
                at, n = b, n + 1
        return True, "".join([*pieces, text[at:]]), n, lost


def repair(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", learned: Learned | None = None, threshold: float = 1.0) -> DataFrame:
    """(key, garbled, restored, n_restored, n_lost) of every row.

    ``garbled``: the text, wholly or in part, was decoded with the wrong encoding. ``restored``: the text with
    the garbled runs as they were meant, null where nothing is garbled or nothing can be had back.
    ``n_lost`` counts U+FFFD, whose bytes are gone: clean text has none, so such a text is garbled with
    certainty; its other runs may still be restored. Null, empty and ASCII texts aren't garbled. Repeated rows are judged alike. A null source is
    one of its own. The weights come from :func:`learn` over the same table unless ``learned`` is given.

    A document is garbled by a swap if the evidence of its distinct windows, each either garbled or not,
    outweighs the swap's weight in the source by ``threshold`` nats.
    """
    learned = learned or learn(df, text, source)
    shared = df.sparkSession.sparkContext.broadcast((learned.counts, learned.general))  # of fixed size
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("garbled", T.BooleanType()), T.StructField("restored", T.StringType()), T.StructField("n_restored", T.IntegerType()), T.StructField("n_lost", T.IntegerType())])

    def run(batches):
        judge = Judge(*shared.value, threshold)
        for batch in batches:
            rows = [(False, None, 0, 0) if not t or t.isascii() else judge.judge(t, own) for t, own in zip(batch.column("__t").to_pylist(), batch.column("own").to_pylist())]
            garbled, restored, n, lost = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(garbled, pa.bool_()), pa.array(restored, pa.string()), pa.array(n, pa.int32()), pa.array(lost, pa.int32())], schema.names)

    texts = df.select(key, F.col(text).alias("__t"), F.col(source).cast("string").alias("__s"))
    return _with_own(texts, learned.own, "__s").select(key, "__t", "own").mapInArrow(run, schema)
