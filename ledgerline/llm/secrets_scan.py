"""Secret scan: patterns propose, a character convolutional network disposes.

Three base kinds come from fixed patterns and always stay. Every long run of token characters is a
wider candidate. A small convolutional network in numpy looks at it through a window that slides
over the whole run and the characters around it; the largest score counts. It is trained at
start-up on a table of labelled findings made from rules; Platt scaling calibrates its score on
held-out findings, and the threshold is the highest that keeps the wanted recall there, counted
over whole texts: a secret that is no candidate is a lost one.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import chunks, prepare

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "network")
LEAST = {"assign": 8, "access": 16, "hex": 32}
#: What the network may judge: 20 or more token characters in a row.
WIDE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
LONG_HEX = re.compile(r"[0-9a-f]{32,}")
#: A window's characters before its place, all of them, how far it slides, and what the last shows after the run.
BEFORE, WIDTH, STEP, AFTER = 24, 72, 24, 12
#: A window of a labelled text shows the secret if it has so many characters of it.
SHOWN = 20
WINDOWS = 4096
RECALL = 0.97
FINDINGS = 6000
SEED = 3


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base kinds: leftmost matches, those too short dropped."""
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    # Runs of these characters never overlap, so asking for 32 finds the same runs as dropping shorter ones.
    out += [(m.start(), m.end(), "hex") for m in LONG_HEX.finditer(text)]
    return out


def candidates(text: str) -> list[tuple[int, int]]:
    """Stretches for the network: every long run of token characters."""
    return [m.span() for m in WIDE.finditer(text)]


def labelled_texts(n: int, seed: int) -> list[tuple[str, tuple[int, int] | None]]:
    """Texts with the place of their secret, if any, from rules: random keys in several alphabets after words
    that announce them, alone or late in a longer run; against paths, names, dates, identifiers, rules and prose."""
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyz"
    many = letters + letters.upper() + "0123456789"
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randrange(3, 9)))
    out = []
    for _ in range(n):
        lead = " ".join(word() for _ in range(4))
        if rng.random() < 0.5:
            alphabet = rng.choice((many, many + "+/", many + "_-", letters + letters.upper()))
            key = rng.choice(("", "", "sk_", "ghp_", "xoxb-", "eyJ")) + "".join(rng.choice(alphabet) for _ in range(rng.randrange(20, rng.choice((28, 60)))))
            lead += rng.choice((" ", " key: ", " auth=", ' bearer "', " private ", " ", " see ", " at ", " id "))
            kind = rng.randrange(6)
            if kind == 0:
                lead += "/".join(word() for _ in range(rng.randrange(2, 16))) + "/"
            elif kind == 1:
                lead += rng.choice("=-_") * rng.randrange(16, 90)
            after = rng.choice(("", "", "", "/" + "/".join(word() for _ in range(rng.randrange(1, 8))))) if kind < 2 else ""
            out.append((lead + key + after + " " + word(), (len(lead), len(lead) + len(key))))
        else:
            kind = rng.randrange(11)
            if kind == 0:
                key = "/".join(word() for _ in range(4)) + f"/{rng.randrange(1000, 999999)}"
            elif kind == 1:
                key = "-".join(word() for _ in range(3)) + f"-20{rng.randrange(10, 26)}-{rng.randrange(10, 13)}-{rng.randrange(10, 29)}"
            elif kind == 2:
                key = "_".join(f"{word()}{rng.randrange(99)}" for _ in range(4))
            elif kind == 3:
                key = "=" * rng.randrange(16, 30) + word() + str(rng.randrange(100, 9999))
            elif kind == 4:
                key = "".join(word() for _ in range(4)) + str(rng.randrange(100, 99999))
            elif kind == 5:
                key = "".join(word() for _ in range(rng.randrange(4, 8)))
            elif kind == 6:
                key = "".join(word().capitalize() for _ in range(rng.randrange(4, 8)))
            elif kind == 7:
                key = "_".join(word().upper() for _ in range(rng.randrange(3, 7)))
            elif kind == 8:
                key = rng.choice("=-_/+") * rng.randrange(20, 150)
            elif kind == 9:
                key = "/".join(word() for _ in range(rng.randrange(5, 24)))
            else:
                key = rng.choice("-_").join(word() for _ in range(rng.randrange(5, 16)))
            lead += rng.choice((" ", " see ", " at ", " id ", " ", " key: ", " private "))
            out.append((lead + key + " " + word(), None))
    return out


def windows_of(text: str, start: int, end: int) -> Iterator[tuple[int, str]]:
    """Place and view of every window of a run; together they show all of it, and the text after it."""
    for place in range(start, start + max(0, end - start + AFTER - WIDTH + BEFORE) + STEP, STEP):
        yield place, window(text, place)


def labelled_findings(n: int, seed: int) -> tuple[list[str], np.ndarray]:
    """Windows of the runs of ``n`` labelled texts, with the label 1 where they show a secret; those that show
    a few characters of one are left out."""
    return findings_of(labelled_texts(n, seed))


def findings_of(texts: list[tuple[str, tuple[int, int] | None]]) -> tuple[list[str], np.ndarray]:
    windows, labels = [], []
    for text, secret in texts:
        for start, end in candidates(text):
            for place, view in windows_of(text, start, end):
                shown = max(0, min(secret[1], place + WIDTH - BEFORE) - max(secret[0], place - BEFORE)) if secret else 0
                if shown == 0 or shown >= SHOWN:
                    windows.append(view)
                    labels.append(int(shown > 0))
    return windows, np.array(labels)


def window(text: str, place: int) -> str:
    """A fixed view: what stands before the place, and what from there on."""
    return text[max(0, place - BEFORE) : place].rjust(BEFORE, "\0") + text[place : place + WIDTH - BEFORE].ljust(WIDTH - BEFORE, "\0")


def as_codes(windows: list[str]) -> np.ndarray:
    data = "".join(windows).encode("ascii", "replace")
    return np.frombuffer(data, np.uint8).reshape(len(windows), WIDTH).astype(np.int64)


class Network:
    """Embedding, one convolution, largest value over places, one layer to a score."""

    def __init__(self, seed: int, width: int = 8, filters: int = 24, span: int = 5):
        rng = np.random.default_rng(seed)
        self.span = span
        self.w = {
            "e": rng.normal(0, 0.5, (128, width)), "c": rng.normal(0, 0.2, (span * width, filters)), "b": np.zeros(filters),
            "o": rng.normal(0, 0.3, 2 * filters), "z": np.zeros(1),
        }
        self.scale, self.shift, self.limit = 1.0, 0.0, 0.5

    def _forward(self, codes: np.ndarray):
        own = self.w["e"][codes]
        places = codes.shape[1] - self.span + 1
        wide = np.concatenate([own[:, k : k + places] for k in range(self.span)], axis=2)
        raw = wide @ self.w["c"] + self.w["b"]
        active = np.maximum(raw, 0)
        top, mean = active.max(axis=1), active.mean(axis=1)
        return wide, raw, active, np.hstack([top, mean])

    def raw_score(self, codes: np.ndarray) -> np.ndarray:
        return self._forward(codes)[3] @ self.w["o"] + self.w["z"]

    def probability(self, codes: np.ndarray) -> np.ndarray:
        out = [self.likely(self.raw_score(codes[s : s + 512])) for s in range(0, len(codes), 512)]
        return np.concatenate(out) if out else np.zeros(0)

    def likely(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * raw + self.shift, -30, 30)))

    def largest(self, texts: list[str], rows: list[tuple[int, int, int]]) -> np.ndarray:
        """Largest raw score over the windows of every (text, start, end)."""
        out = np.full(len(rows), -np.inf)
        views = ((k, view) for k, (i, s, e) in enumerate(rows) for _, view in windows_of(texts[i], s, e))
        while some := list(islice(views, WINDOWS)):
            codes = as_codes([view for _, view in some])
            raw = np.concatenate([self.raw_score(codes[s : s + 512]) for s in range(0, len(codes), 512)])
            np.maximum.at(out, [k for k, _ in some], raw)
        return out

    def judged(self, texts: list[str], rows: list[tuple[int, int, int]]) -> np.ndarray:
        """Whether every (text, start, end) is a secret."""
        return self.likely(self.largest(texts, rows)) >= self.limit

    def fit(self, codes: np.ndarray, labels: np.ndarray, seed: int, rounds: int = 12, size: int = 64, rate: float = 0.01) -> None:
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        step = 0
        for _ in range(rounds):
            order = rng.permutation(len(codes))
            for s in range(0, len(order), size):
                own = order[s : s + size]
                grads = self._gradients(codes[own], labels[own])
                step += 1
                for k, g in grads.items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.w[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)

    def _gradients(self, codes: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        wide, raw, active, pooled = self._forward(codes)
        n, places, filters = raw.shape
        error = (1 / (1 + np.exp(-(pooled @ self.w["o"] + self.w["z"]))) - labels) / n
        back = error[:, None] * self.w["o"]
        deep = np.repeat(back[:, None, filters:] / places, places, axis=1)
        best = active.argmax(axis=1)
        np.add.at(deep, (np.arange(n)[:, None], best, np.arange(filters)), back[:, :filters])
        deep *= raw > 0
        flat = deep.reshape(-1, filters)
        to_wide = (flat @ self.w["c"].T).reshape(n, places, self.span, -1)
        to_e = np.zeros_like(self.w["e"])
        for k in range(self.span):
            np.add.at(to_e, codes[:, k : k + places], to_wide[:, :, k])
        return {"e": to_e, "c": wide.reshape(-1, wide.shape[2]).T @ flat, "b": flat.sum(axis=0), "o": pooled.T @ error, "z": np.array([error.sum()])}

    def calibrate(self, texts: list[tuple[str, tuple[int, int] | None]], recall: float) -> None:
        """Platt scaling by Newton steps over the candidates of labelled texts, then the highest limit with
        the wanted recall of their secrets; a secret outside all candidates scores 0."""
        rows = [(i, s, e) for i, (text, _) in enumerate(texts) for s, e in candidates(text)]
        hits = [secret is not None and s <= secret[0] and secret[1] <= e for (i, s, e) in rows for secret in (texts[i][1],)]
        labels, secrets = np.array(hits, int), sum(secret is not None for _, secret in texts)
        raw = self.largest([text for text, _ in texts], rows)
        target = np.where(labels == 1, (labels.sum() + 1) / (labels.sum() + 2), 1 / ((labels == 0).sum() + 2))
        x, theta = np.column_stack([raw, np.ones_like(raw)]), np.array([1.0, 0.0])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
            hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
            theta -= np.linalg.solve(hessian, x.T @ (p - target) + 1e-2 * theta)
        self.scale, self.shift = theta
        own = self.likely(raw)[labels == 1]
        own = np.sort(np.concatenate([np.zeros(secrets - len(own)), own]))
        self.limit = float(own[int((1 - recall) * len(own))])


def trained(seed: int = SEED) -> Network:
    texts = labelled_texts(FINDINGS, seed)
    cut = FINDINGS * 3 // 4
    windows, labels = findings_of(texts[:cut])
    net = Network(seed)
    net.fit(as_codes(windows), labels, seed)
    net.calibrate(texts[cut:], RECALL)
    return net


def joined(spans: list[tuple[int, int, str]]) -> str:
    ordered = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    return ",".join(f"{k}:{s}:{e}" for s, e, k in ordered)


def _scan(net: Network):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, _, _ in chunks(batch.column("text")):
                texts = [t or "" for t in batch.column("text").slice(first, end - first).to_pylist()]
                found = [base_spans(t) for t in texts]
                extra = [(i, s, e) for i, t in enumerate(texts) for s, e in candidates(t)]
                spans = [list(f) for f in found]
                for (i, s, e), secret in zip(extra, net.judged(texts, extra)):
                    if secret and all(e <= a or b <= s for a, b, _ in found[i]):
                        spans[i].append((s, e, "network"))
                count = lambda k: pa.array([sum(x[2] == k for x in f) for f in found], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, end - first), *map(count, KINDS[:3]),
                        pa.array([hashlib.sha256(joined(f).encode()).hexdigest() for f in found], pa.string()),
                        pa.array([joined(s) for s in spans], pa.string()),
                    ],
                    names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
                )

    return run


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) for every row of ``docs``; places are code
    points. A null text is empty and has no spans. Repeated rows give repeated results; other columns are not read."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scan(trained()), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redacted(text: str, net: Network) -> str:
    spans = base_spans(text)
    extra = candidates(text)
    spans += [(s, e, "network") for (s, e), secret in zip(extra, net.judged([text], [(0, s, e) for s, e in extra])) if secret]
    out, at = [], 0
    for s, e, _ in sorted(spans):
        if e > at:
            out += [text[at : max(at, s)], "" if s < at else "[secret]"]
            at = e
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every found span replaced; all rows and columns stay, n_chars follows the text."""
    prepare(docs.sparkSession)
    net = trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if t is None else redacted(t, net) for t in batch.column("text").to_pylist()]
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
