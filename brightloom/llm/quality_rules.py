"""Quality rules of a text, and content lines by a linear-chain conditional random field."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import arrow_pass, fold_of, only, window_hashes, word_hashes

#: Labelled rows of each class that the field is fitted on, at most.
SAMPLE = 2_000
#: Least share of a text's words in content lines.
CONTENT_SHARE = 0.5
SYMBOLS = "#*$%&|<>"
_SYMBOL_BYTES = SYMBOLS.encode()
_CLOSE = tuple(".!?:;…\"'»”)")
FEATURES = ("any", "few words", "many words", "symbols", "capitals", "repeated words", "no closing mark",
            "bars", "doubled marks", "seen before", "long words", "no letters")
_ASCII_SPACE = " \t\n\v\f\r"


def rules(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text."""
    words = text.split()
    seen, again = set(), 0
    for line in text.split(b"\n"):
        if line in seen:
            again += 1
        elif line.strip(b" \t\v\f\r"):
            seen.add(line)
    g = window_hashes(word_hashes(words), 3)
    covered = 0
    if len(g):
        _, which, times = np.unique(g, return_inverse=True, return_counts=True)
        often = times[which] > 1
        mark = np.zeros(len(words), bool)
        for shift in range(3):
            mark[shift:shift + len(g)] |= often
        covered = int(mark.sum())
    return (len(words), len(b"".join(words).decode()), len(text) - len(text.translate(None, _SYMBOL_BYTES)), again, covered)


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 50 or 100 * n_repeat_words > 50 * n_words


def line_codes(text: str) -> tuple[list[int], list[int]]:
    """For each line with a word, its features as bits, and its words."""
    codes, sizes, seen = [], [], set()
    for line in text.split("\n"):
        words = [w for w in line.translate(_TO_SPACE).split(" ") if w]
        if not words:
            continue
        n = len(words)
        bare = line.strip(_ASCII_SPACE)
        symbols = sum(line.count(c) for c in SYMBOLS)
        bits = (True, n <= 3, n >= 10, 5 * symbols > n, line.isupper(), n >= 6 and 2 * len(set(words)) < n,
                not bare.endswith(_CLOSE), 5 * line.count("|") > n, 5 * (line.count("!!") + line.count("??")) > n, line in seen,
                len(bare) > 12 * n, not any(map(str.isalpha, bare)))
        seen.add(line)
        codes.append(sum(1 << i for i, bit in enumerate(bits) if bit))
        sizes.append(n)
    return codes, sizes


_TO_SPACE = str.maketrans(dict.fromkeys(_ASCII_SPACE, " "))


@dataclass(frozen=True)
class Field:
    """Score of label content over boilerplate per feature, and of each pair of neighbours
    (rows: earlier label, 0 boilerplate)."""

    unary: tuple[float, ...]
    pairs: tuple[tuple[float, float], tuple[float, float]]

    def content(self, codes: list[int]) -> list[bool]:
        """Most likely labels of a text's lines (Viterbi); content on ties."""
        if not codes:
            return []
        (bb, bc), (cb, cc) = self.pairs
        weight = {c: sum(w for i, w in enumerate(self.unary) if c >> i & 1) for c in set(codes)}
        back: list[tuple[bool, bool]] = []
        low, high = 0.0, weight[codes[0]]
        for code in codes[1:]:
            stay, come = low + bb, high + cb
            leave, hold = low + bc, high + cc
            back.append((come >= stay, hold >= leave))
            low, high = max(stay, come), max(leave, hold) + weight[code]
        label = high >= low
        out = [label]
        for from_low, from_high in reversed(back):
            label = from_high if label else from_low
            out.append(label)
        return out[::-1]


def _expected(unary: np.ndarray, pairs: np.ndarray, start: np.ndarray, sizes: np.ndarray):
    """Log likelihood parts of many chains at once: log Z, content probability per line and
    expected neighbour counts. Chains must come longest first."""
    steps = int(sizes[0])
    active = [int((sizes > t).sum()) for t in range(steps)]
    alpha = np.zeros((len(unary), 2))
    beta = np.zeros((len(unary), 2))
    alpha[start, 1] = unary[start]
    for t in range(1, steps):
        at = start[:active[t]] + t
        alpha[at] = np.logaddexp.reduce(alpha[at - 1][:, :, None] + pairs[None], axis=1)
        alpha[at, 1] += unary[at]
    local = np.column_stack([np.zeros(len(unary)), unary])
    for t in range(steps - 2, -1, -1):
        at = start[:active[t + 1]] + t
        beta[at] = np.logaddexp.reduce(pairs[None] + (local[at + 1] + beta[at + 1])[:, None, :], axis=2)
    z = np.logaddexp.reduce(alpha[start + sizes - 1], axis=1)
    of = np.repeat(z, sizes)[np.argsort(np.concatenate([np.arange(s, s + n) for s, n in zip(start, sizes, strict=True)]))]
    content = np.exp(alpha[:, 1] + beta[:, 1] - of)
    inner = np.ones(len(unary), bool)
    inner[start] = False
    at = np.flatnonzero(inner)
    joint = np.exp(alpha[at - 1][:, :, None] + pairs[None] + (local[at] + beta[at])[:, None, :] - of[at][:, None, None])
    return z.sum(), content, joint.sum(axis=0)


def fit_chains(chains: list[list[int]], labels: list[list[int]], rounds: int = 150, ridge: float = 1.0) -> Field:
    """Maximum likelihood of a linear-chain field, by gradient steps with momentum.

    Without a line the field calls everything content."""
    order = sorted((i for i in range(len(chains)) if chains[i]), key=lambda i: -len(chains[i]))
    if not order:
        return Field((1.0,) + (0.0,) * (len(FEATURES) - 1), ((0.0, 0.0), (0.0, 0.0)))
    sizes = np.array([len(chains[i]) for i in order])
    start = np.r_[0, np.cumsum(sizes)[:-1]]
    code = np.array([c for i in order for c in chains[i]])
    x = (code[:, None] >> np.arange(len(FEATURES)) & 1).astype(float)
    y = np.array([v for i in order for v in labels[i]], float)
    inner = np.ones(len(y), bool)
    inner[start] = False
    at = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[at - 1].astype(int), y[at].astype(int)), 1)
    unary, pairs = np.zeros(len(FEATURES)), np.zeros((2, 2))
    speed_u, speed_p, n = 0 * unary, 0 * pairs, len(y)
    for _ in range(rounds):
        _, content, joint = _expected(x @ unary, pairs, start, sizes)
        speed_u = 0.9 * speed_u + (x.T @ (y - content) - ridge * unary) / n
        speed_p = 0.9 * speed_p + (seen - joint - ridge * pairs) / n
        unary, pairs = unary + 1.0 * speed_u, pairs + 1.0 * speed_p
    return Field(tuple(unary.tolist()), tuple(tuple(r) for r in pairs.tolist()))


def fit_field(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              label_col: str = "quality", sample: int = SAMPLE) -> Field:
    """A field from labelled rows whose id's crc32 modulo 5 is not 0.

    At most `sample` rows of each class are used, those with the least id hashes. The
    lines of a good document stand for content, those of a poor one for boilerplate.
    Null labels and ids are left out."""
    marks = only(labels, **{id_col: "doc_id", label_col: "label"}).where(
        F.col("doc_id").isNotNull() & F.col("label").isNotNull() & (fold_of(F.col("doc_id")) != 0)).select(
        "doc_id", (F.col("label") > 0).cast("int").alias("label")).distinct()
    chosen = None
    for label in (0, 1):
        part = marks.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        chosen = part if chosen is None else chosen.union(part)
    rows = only(docs, **{id_col: "doc_id", text_col: "text"}).join(F.broadcast(chosen), "doc_id").select("text", "label")

    def code(batch: pa.RecordBatch) -> dict:
        return {"codes": [line_codes(t or "")[0] for t in batch.column("text").to_pylist()], "label": batch.column("label")}

    got = arrow_pass(rows, code, "codes array<int>, label int").toArrow()
    pairs = sorted(zip(got.column("codes").to_pylist(), got.column("label").to_pylist(), strict=True))
    return fit_chains([c for c, _ in pairs], [[v] * len(c) for c, v in pairs])


def judge_quality(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text",
                  content_share: float = CONTENT_SHARE) -> DataFrame:
    """Per row: doc_id, the counts of ``rules``, content_words, base_failed and kept.

    A row is kept if it passes the base rules and at least `content_share` of its words
    stand in lines that the field calls content. Null and empty texts have no words and
    fail. Null ids and repeated rows are judged like others, other columns ignored; no
    rows give no rows."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "content_words")

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {c: [] for c in names}
        failed, kept = [], []
        for text in batch.column("text").to_pylist():
            text = text or ""
            codes, sizes = line_codes(text)
            content = sum(n for n, good in zip(sizes, field.content(codes), strict=True) if good)
            counts = (*rules(text.encode()), content)
            for name, value in zip(names, counts, strict=True):
                out[name].append(value)
            failed.append(base_failed(counts[0], counts[4]))
            kept.append(not failed[-1] and content >= content_share * counts[0])
        return {"doc_id": batch.column("doc_id"), **out, "base_failed": failed, "kept": kept}

    rows = only(docs, **{id_col: "doc_id", text_col: "text"}).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return arrow_pass(rows, run, "doc_id long, " + ", ".join(f"{c} long" for c in names) + ", base_failed boolean, kept boolean")
