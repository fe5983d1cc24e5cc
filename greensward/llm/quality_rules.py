"""Quality rules: text counts, then a linear-chain CRF over a document's lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greensward.llm.memory import give_back, text_batches
from greensward.llm.sampling import hashed_rows

#: Fixed values of the contract.
SPACES, SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"
WINDOW, MIN_WORDS, MAX_REPEAT_PERCENT = 8, 20, 30

UPPER, LOWER = bytes(range(65, 91)), bytes(range(97, 123))
DIGITS, STOPS = b"0123456789", (b".", b"?", b"!", b":", b'"', b"\xe2\x80\xa6")
#: Phrases that mark a line as licence, cookie or navigation text when the first labels are set, in four languages.
CUES = tuple(x.encode() for x in (
    "copyright", "licensed under", "all rights reserved", "cookie", "terms of use", "privacy policy", "subscribe", "click here",
    "alle rechte vorbehalten", "datenschutzerklärung", "nutzungsbedingungen", "impressum", "hier klicken", "abonnieren",
    "tous droits réservés", "politique de confidentialité", "conditions d'utilisation", "mentions légales", "cliquez ici", "abonnez-vous",
    "todos los derechos reservados", "política de privacidad", "términos de uso", "condiciones de uso", "haga clic aquí", "suscríbete",
))
#: Feature names, in the order of the columns of ``line_features``.
FEATURES = ("bias", "log_bytes", "symbols", "upper", "digits", "pipes", "bangs", "stop", "repeats", "cue", "short", "word_length", "stutter", "first")
CONTENT, BOILERPLATE, UNKNOWN = 0, 1, -1
#: Documents used to fit the CRF, lines that each of them lends, and the share of content below which a document goes.
SAMPLE_DOCS, SAMPLE_LINES, MIN_CONTENT = 1000, 48, 0.3
#: Lines whose features are held at a time, and cells of lines that Viterbi decodes together.
CHUNK_LINES, DECODE_LINES = 4096, 1 << 17

_RANDOM = np.random.default_rng(8).integers(1, 1 << 63, 4096, dtype=np.uint64) | np.uint64(1)


def _count(b: bytes, chars: bytes) -> int:
    return len(b) - len(b.translate(None, chars))


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words found twice or more."""
    if len(words) <= window:
        return 0
    ids: dict[bytes, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.uint64, len(words))
    if len(ids) == len(words):
        return 0
    a = (a + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    a ^= a >> np.uint64(31)
    n = len(a) - window + 1
    h = np.zeros(n, np.uint64)
    for k in range(window):
        h += a[k : k + n] * _RANDOM[k]
    s = np.sort(h)
    twice = s[1:][s[1:] == s[:-1]]
    if not len(twice):
        return 0
    start = np.flatnonzero(np.isin(h, twice))
    edge = np.zeros(len(a) + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def text_counts(b: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one UTF-8 text."""
    words = b.split()
    chars = len(b) - _count(b, bytes(range(0x80, 0xC0)))  # without continuation bytes
    lines = [x for x in b.split(b"\n") if x.strip(SPACES)]
    return len(words), chars - _count(b, SPACES), _count(b, SYMBOLS), len(lines) - len(set(lines)), repeated_words(words)


def line_features(b: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features and UTF-8 lengths of the lines with a word, a row for each, ``CHUNK_LINES`` at a time; whole lines of any length."""
    seen: set[bytes] = set()
    rows, sizes, first = [], [], 1.0
    for x in b.split(b"\n"):
        words = x.split()
        if not words:
            continue
        n, up, low = len(x), _count(x, UPPER), _count(x, LOWER)
        small = x.lower()
        rows.append((
            1.0, np.log1p(n) / 8, min(1.0, 5 * _count(x, b"#*$%&<>") / n), up / (up + low) if up + low else 0.5, _count(x, DIGITS) / n,
            min(1.0, 4 * x.count(b"|") / len(words)), min(1.0, 2 * x.count(b"!!") / len(words)), float(x.rstrip(SPACES).endswith(STOPS)),
            float(x in seen), float(any(c in small for c in CUES)), float(len(words) < 4), min(2.0, n / len(words) / 10),
            sum(map(bytes.__eq__, words, words[1:])) / len(words), first,
        ))
        sizes.append(n)
        seen.add(x)
        first = 0.0
        if len(rows) == CHUNK_LINES:
            yield np.array(rows, np.float64), np.array(sizes, np.int64)
            rows, sizes = [], []
    if rows:
        yield np.array(rows, np.float64), np.array(sizes, np.int64)


def line_emissions(b: bytes, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores ``(lines, 2)`` of the labels of a text's lines, and their lengths."""
    parts = [(x @ w, n) for x, n in line_features(b)]
    if not parts:
        return np.zeros((0, 2)), np.zeros(0, np.int64)
    return np.concatenate([e for e, _ in parts]), np.concatenate([n for _, n in parts])


def seed_labels(x: np.ndarray) -> np.ndarray:
    """First labels by plain rules, where these are sure: noise and stock phrases, and sentences without either. Other lines stay unknown."""
    f = {k: x[:, i] for i, k in enumerate(FEATURES)}
    noisy = (f["symbols"] > 0.25) | (f["pipes"] > 0.5) | (f["bangs"] > 0.5)
    bad = noisy | (f["stutter"] > 0.4) | (f["repeats"] > 0) | (f["cue"] > 0)
    good = ~bad & (f["stop"] > 0) & (f["short"] == 0) & (f["symbols"] < 0.05) & (f["upper"] < 0.3) & (f["digits"] < 0.2)
    return np.where(bad, BOILERPLATE, np.where(good, CONTENT, UNKNOWN))


def _pad(seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    n = np.array([len(s) for s in seqs])
    out = np.zeros((len(seqs), int(n.max()), *seqs[0].shape[1:]))
    for i, s in enumerate(seqs):
        out[i, : len(s)] = s
    return out, n


def _expected(e: np.ndarray, t: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities ``(lines, docs, 2)`` and expected transitions of scores ``e``, by scaled forward-backward."""
    m = len(e)
    g, step = np.exp(e - e.max(2, keepdims=True)), np.exp(t - t.max())
    a, b = g.copy(), np.ones_like(g)
    for k in range(1, m):
        v = (a[k - 1] @ step) * g[k]
        a[k] = v / v.sum(1, keepdims=True)
    for k in range(m - 2, -1, -1):
        v = (g[k + 1] * b[k + 1]) @ step.T
        b[k] = np.where(there[k + 1, :, None], v / v.sum(1, keepdims=True), 1.0)
    p = a * b
    p *= there[..., None] / p.sum(2, keepdims=True)
    q = a[:-1, :, :, None] * step * (g * b)[1:, :, None, :]
    q *= (there[1:] / q.sum((2, 3)))[..., None, None]
    return p, q.sum((0, 1))


def fit_crf(docs: list[np.ndarray], labels: list[np.ndarray], steps: int = 60, rate: float = 0.25, decay: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights ``(features, 2)`` and transitions ``(2, 2)`` that make the known labels likeliest, by Adam.

    Unknown labels are summed over: the gradient is what forward-backward
    expects with the known labels held, less what it expects freely, so a line
    that no rule labels is learned from its features and its neighbours.
    """
    w, t = np.zeros((len(FEATURES), 2)), np.zeros((2, 2))
    both = [(x, y) for x, y in zip(docs, labels, strict=True) if len(x)]
    if not both:
        return w, t
    x, n = _pad([a for a, _ in both])
    x = np.ascontiguousarray(x.transpose(1, 0, 2))
    y = np.full(x.shape[:2], UNKNOWN)
    for i, (_, b) in enumerate(both):
        y[: len(b), i] = b
    there = np.arange(len(x))[:, None] < n
    held = np.where((y[..., None] == UNKNOWN) | (np.arange(2) == y[..., None]), 0.0, -200.0)
    total, mom = there.sum(), [np.zeros_like(w), np.zeros_like(t), np.zeros_like(w), np.zeros_like(t)]
    for step in range(1, steps + 1):
        e = x @ w
        p, q = _expected(e + held, t, there)
        free_p, free_q = _expected(e, t, there)
        for i, (v, g) in enumerate(((w, np.tensordot(x, p - free_p, ((0, 1), (0, 1))) / total - decay * w), (t, (q - free_q) / total - decay * t))):
            mom[i] = 0.9 * mom[i] + 0.1 * g
            mom[i + 2] = 0.99 * mom[i + 2] + 0.01 * g * g
            v += rate * (mom[i] / (1 - 0.9**step)) / (np.sqrt(mom[i + 2] / (1 - 0.99**step)) + 1e-9)
    return w, t


def viterbi(docs: list[np.ndarray], t: np.ndarray) -> list[np.ndarray]:
    """The likeliest labels of each document's lines from their scores; documents of like length go together, ``DECODE_LINES`` cells (or one document) at a time."""
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(docs)
    order = sorted((i for i in range(len(docs)) if len(docs[i])), key=lambda i: len(docs[i]))
    at = 0
    while at < len(order):
        n = len(docs[order[at]])
        most = max(16, int(n * 1.25))
        group = [i for i in order[at : at + max(1, min(512, DECODE_LINES // most))] if len(docs[i]) <= most]
        at += len(group)
        e, n = _pad([docs[i] for i in group])
        score, back = e[:, 0], np.zeros((*e.shape[:2], 2), np.int8)
        final = score.copy()
        for k in range(1, e.shape[1]):
            stay = score[:, :, None] + t
            back[:, k] = stay.argmax(1)
            score = stay.max(1) + e[:, k]
            live = n > k
            final[live] = score[live]
        label = final.argmax(1)
        path = np.zeros(e.shape[:2], np.int64)
        for k in range(e.shape[1] - 1, -1, -1):
            live = n > k
            path[live, k] = label[live]
            if k:
                label = np.where(live, back[np.arange(len(group)), k, label], label)
        for j, i in enumerate(group):
            out[i] = path[j, : n[j]]
    return out


def fit_line_crf(docs: DataFrame, text: str = "text", sample_docs: int = SAMPLE_DOCS) -> tuple[np.ndarray, np.ndarray]:
    """Fit the CRF to runs of lines of the ``sample_docs`` distinct texts with the smallest hashes.

    Copies count once, so a text that fills most of the table doesn't crowd the
    others out. A text of any length takes part, by ``SAMPLE_LINES`` lines in a row from a
    place that the hash chooses; only these lines' features reach the driver.
    """
    k = len(FEATURES)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for h, t in zip(batch.column("h").to_pylist(), batch.column("t"), strict=True):
                b = t.as_py().encode()
                lines = sum(1 for x in b.split(b"\n") if x.strip(SPACES))
                at, seen, rows = h % max(1, lines - SAMPLE_LINES + 1), 0, []
                for x, _ in line_features(b):
                    rows.append(x[max(0, at - seen) : max(0, at + SAMPLE_LINES - seen)])
                    seen += len(x)
                out.append((h, np.concatenate(rows or [np.zeros((0, k))]).astype("<f4").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.binary())], names=["h", "x"])

    some = docs.select(docs[text].alias("t")).where("t <> ''").withColumn("i", F.xxhash64("t"))
    found = hashed_rows(some, "i", sample_docs).select("h", "t").mapInArrow(runs, "h bigint, x binary").collect()
    x = [np.frombuffer(b, "<f4").astype(float).reshape(-1, k) for b in sorted(bytes(r.x) for r in found)]
    return fit_crf(x, [seed_labels(a) for a in x])


VERDICT = "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,base_failed:boolean,content_share:double,kept:boolean>"


def quality_rules(docs: DataFrame, text: str = "text", *, min_content: float = MIN_CONTENT, crf: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """``docs`` with one more column ``quality``, a struct of counts and verdict.

    A document fails the base rules with under 20 words or with over 30 % of
    its words in repeated 8-word windows. For the others a linear-chain CRF
    labels each line with a word as content or boilerplate (Viterbi);
    ``content_share`` is the share of content in the bytes of these lines, and
    a document is kept if that is at least ``min_content``. The CRF is fitted
    on a bounded sample of ``docs`` (``fit_line_crf``) unless one is given.

    A null or empty text has no words and isn't kept, with a share of 0. Lines and texts of any length are read whole,
    their features in chunks. A label's tie goes to content. Repeated rows get
    the same verdict and enter the sample once. An empty table gives an empty
    result. A column named ``quality`` is replaced; others are left alone.
    """
    text_batches(docs.sparkSession)
    w, t = crf if crf is not None else fit_line_crf(docs, text)

    @F.arrow_udf(VERDICT)
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            base, lines, sizes = [], [], []
            for x in batch:
                b = (x.as_py() or "").encode()
                c = text_counts(b)
                base.append((*c, c[0] < MIN_WORDS or 100 * c[4] > MAX_REPEAT_PERCENT * c[0]))
                e, n = line_emissions(b, w) if not base[-1][5] else (np.zeros((0, 2)), np.zeros(0, np.int64))
                lines.append(e)
                sizes.append(n)
            labels = viterbi(lines, t)
            share = [float(n[y == CONTENT].sum() / n.sum()) if len(n) else 0.0 for n, y in zip(sizes, labels, strict=True)]
            cols = [pa.array([r[i] for r in base], pa.int64()) for i in range(5)]
            fail = np.array([r[5] for r in base], bool)
            cols += [pa.array(fail), pa.array(share, pa.float64()), pa.array(~fail & (np.array(share) >= min_content))]
            give_back()
            yield pa.StructArray.from_arrays(cols, ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "content_share", "kept"])

    return docs.withColumn("quality", judge.asNondeterministic()(docs[text]))


def op2_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return quality_rules(docs).select("doc_id", "quality.*")
