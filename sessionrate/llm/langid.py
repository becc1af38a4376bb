"""Operator 5: language identification by a bidirectional gated recurrent network on bytes.

The network reads bytes in both directions with gated recurrent units, gives every byte
position a probability for each language, and a document's probabilities are the mean over
all its positions.  Its context is the word: the state starts anew after each separator
(``[\\x20\\x09-\\x0D]``; the word's last position is the separator itself; words of over
``CHUNK`` bytes are read in pieces of at most that length, cut between characters).  So
equal words have equal positions everywhere, and a task computes each distinct word of its
batches once; every occurrence still counts.

Training (numpy, backpropagation through time, Adam) uses a bounded sample of the labelled
rows: up to ``SAMPLE_DOCS`` documents per language, rows equal in id and text as one, whole
texts; a hash of id and text decides which.  Their words are counted in Spark; of a language
with more than ``SAMPLE_PIECES`` different ones a hash of the word keeps about that many, from
all over the texts.  Prediction reads whole texts.

Defined cases: NULL text, or a text without a letter, is ``und`` with score 0; so is every
text if nothing is labelled; ties go to the first language in order; a NULL id counts as
the empty id; repeated rows get equal predictions; extra columns are carried, those named
like an output column are replaced; no documents give no rows.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionrate.llm.common import hash01, map_text, materialize, portions

HIDDEN = 16
CHUNK = 32
SAMPLE_DOCS = 300          # labelled documents per language that training may use
SAMPLE_PIECES = 100_000    # different words of theirs per language, about
STEPS, BATCH, RATE = 600, 256, 0.02
CACHE_WORDS = 300_000      # distinct words a task keeps (about 100 bytes each)
UND = "und"
_GATES = 3


def pieces(word: bytes) -> list[bytes]:
    """The sequences a word is read in: up to CHUNK bytes, whole characters."""
    whole = word + b" "
    if len(whole) <= CHUNK:
        return [whole]
    out, start = [], 0
    while start < len(whole):
        end = min(start + CHUNK, len(whole))
        while start + CHUNK - 4 < end < len(whole) and whole[end] & 0xC0 == 0x80:
            end -= 1
        out.append(whole[start:end])
        start = end
    return out


def count_pieces(pairs) -> dict[str, Counter]:
    """Language -> how often each piece occurs in its texts, from (text, language) pairs."""
    words: dict[str, Counter] = {}
    for text, lang in pairs:
        own = words.setdefault(lang, Counter())
        for w, n in Counter(text.encode("utf-8", "surrogatepass").split()).items():
            for piece in pieces(w):
                own[piece] += n
    return words


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-x))


@dataclass
class Net:
    """Parameters: per direction an input table (byte -> gates) and recurrent weights."""

    langs: list[str]
    params: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, langs, seed=0, hidden=HIDDEN):
        rng, g = np.random.default_rng(seed), _GATES * hidden
        p = {}
        for d in "fb":
            p["x" + d] = rng.normal(0, 0.3, (256, g))
            p["u" + d] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, g))
            p["c" + d] = np.zeros(g)
        p["o"] = rng.normal(0, 0.2, (2 * hidden, len(langs)))
        p["oc"] = np.zeros(len(langs))
        return cls(list(langs), {k: v.astype(np.float32) for k, v in p.items()})

    def _run(self, seq, d, keep=None):
        """States after each byte of equally long sequences: (length, batch, hidden)."""
        p, n = self.params, self.params["u" + d].shape[0]
        h = np.zeros((len(seq), n), dtype=np.float32)
        table, u, c = p["x" + d], p["u" + d], p["c" + d]
        out = np.empty((seq.shape[1], len(seq), n), dtype=np.float32)
        for t in range(seq.shape[1]):
            x, hu = table[seq[:, t]] + c, h @ u
            zr = _sigmoid(x[:, :2 * n] + hu[:, :2 * n])
            z, r = zr[:, :n], zr[:, n:]
            cand = np.tanh(x[:, 2 * n:] + r * hu[:, 2 * n:])
            if keep is not None:
                keep.append((h, z, r, cand, hu[:, 2 * n:]))
            h = cand + z * (h - cand)
            out[t] = h
        return out

    def positions(self, seq, keep_f=None, keep_b=None):
        """Probability of each language at every position: (length, batch, languages)."""
        f = self._run(seq, "f", keep_f)
        b = self._run(seq[:, ::-1], "b", keep_b)[::-1]
        hidden = np.concatenate([f, b], axis=2)
        s = hidden @ self.params["o"] + self.params["oc"]
        e = np.exp(s - s.max(axis=2, keepdims=True))
        return e / e.sum(axis=2, keepdims=True), hidden

    def _back(self, seq, d, keep, grad, grads):
        """Backpropagation through time; ``grad``: of the states, (length, batch, hidden)."""
        u = self.params["u" + d]
        n = u.shape[0]
        later = np.zeros_like(grad[0])
        gates = np.empty((len(grad), grad.shape[1], _GATES * n), dtype=np.float32)
        du = np.zeros_like(u)
        for t in range(len(grad) - 1, -1, -1):
            h, z, r, cand, hu = keep[t]
            dh = grad[t] + later
            dc = dh * (1 - z) * (1 - cand * cand)
            dz = dh * (h - cand) * z * (1 - z)
            dr = dc * hu * r * (1 - r)
            dhu = np.concatenate([dz, dr, dc * r], axis=1)
            du += h.T @ dhu
            later = dh * z + dhu @ u.T
            gates[t] = np.concatenate([dz, dr, dc], axis=1)
        flat = gates.reshape(-1, gates.shape[2])
        hot = np.zeros((len(flat), 256), dtype=np.float32)
        hot[np.arange(len(flat)), seq.T.ravel()] = 1
        grads["x" + d], grads["u" + d], grads["c" + d] = hot.T @ flat, du, flat.sum(axis=0)

    def gradients(self, seq, label):
        """Loss (mean over positions) and its gradients for one batch."""
        kf, kb = [], []
        prob, hidden = self.positions(seq, kf, kb)
        length, batch, _ = prob.shape
        loss = -np.log(prob[:, np.arange(batch), label] + 1e-9).mean()
        ds = prob.copy()
        ds[:, np.arange(batch), label] -= 1
        ds /= length * batch
        flat = ds.reshape(-1, ds.shape[2])
        grads = {"o": hidden.reshape(-1, hidden.shape[2]).T @ flat, "oc": flat.sum(axis=0)}
        dh = ds @ self.params["o"].T
        n = dh.shape[2] // 2
        self._back(seq, "f", kf, dh[:, :, :n], grads)
        self._back(seq[:, ::-1], "b", kb, dh[::-1, :, n:], grads)
        return loss, grads


def train(sample: list[tuple[str, str]], **more) -> Net | None:
    """Network from (text, language) pairs; None without any word."""
    return fit(count_pieces(sample), **more)


def fit(words: dict[str, Counter], steps=STEPS, batch=BATCH, rate=RATE, seed=0) -> Net | None:
    """Network from the counted pieces of each language."""
    langs = sorted(k for k, v in words.items() if v)
    if not langs:
        return None
    net, rng = Net.fresh(langs, seed), np.random.default_rng(seed)
    # sequences by length; each language has the same weight, a word the root of its count
    by_length: dict[int, tuple[list, list, list]] = {}
    for k, lang in enumerate(langs):
        total = sum(c ** 0.5 for c in words[lang].values())
        for w, c in sorted(words[lang].items()):
            seqs, labels, weights = by_length.setdefault(len(w), ([], [], []))
            seqs.append(w)
            labels.append(k)
            weights.append(c ** 0.5 / total)
    lengths = sorted(by_length)
    data = {n: (np.frombuffer(b"".join(by_length[n][0]), dtype=np.uint8).reshape(-1, n),
                np.array(by_length[n][1]), np.cumsum(by_length[n][2])) for n in lengths}
    mass = np.cumsum([data[n][2][-1] * n for n in lengths])       # positions of that length
    first = {k: np.zeros_like(v) for k, v in net.params.items()}
    second = {k: np.zeros_like(v) for k, v in net.params.items()}
    for step in range(1, steps + 1):
        n = lengths[min(np.searchsorted(mass, rng.random() * mass[-1]), len(lengths) - 1)]
        seqs, labels, cum = data[n]
        rows = np.minimum(np.searchsorted(cum, rng.random(batch) * cum[-1]), len(cum) - 1)
        _, grads = net.gradients(seqs[rows], labels[rows])
        slow = rate * min(1.0, 2 * (1 - (step - 1) / steps))
        for k, g in grads.items():
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.001 * (g * g - second[k])
            m, v = first[k] / (1 - 0.9 ** step), second[k] / (1 - 0.999 ** step)
            net.params[k] -= (slow * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
    return net


class Reader:
    """Pools a network's position probabilities over whole texts."""

    def __init__(self, net: Net):
        self.net = net
        self.rows: dict[bytes, int] = {}
        self.sums = np.zeros((0, len(net.langs)))      # summed over a word's positions

    def _learn(self, fresh: list[bytes]) -> None:
        """Add the words' summed probabilities; equally long pieces run together."""
        start = len(self.rows)
        sums = np.zeros((len(fresh), len(self.net.langs)))
        by_length: dict[int, tuple[list, list]] = {}
        for i, w in enumerate(fresh):
            self.rows[w] = start + i
            for piece in pieces(w):
                seqs, of = by_length.setdefault(len(piece), ([], []))
                seqs.append(piece)
                of.append(i)
        for n, (seqs, of) in by_length.items():
            data = np.frombuffer(b"".join(seqs), dtype=np.uint8).reshape(-1, n)
            for i in range(0, len(data), 4096):
                prob, _ = self.net.positions(data[i:i + 4096])
                np.add.at(sums, of[i:i + 4096], prob.sum(axis=0))
        self.sums = np.concatenate([self.sums, sums])

    def pool(self, texts: list[str]) -> np.ndarray:
        """Mean probabilities of each text (texts, languages); rows of texts without
        words are zero."""
        split = [t.encode("utf-8", "surrogatepass").split() for t in texts]
        if len(self.rows) > CACHE_WORDS:
            self.rows, self.sums = {}, self.sums[:0]
        rows, fresh = self.rows, {}
        for words in split:
            fresh.update((w, None) for w in words if w not in rows)
        if fresh:
            self._learn(list(fresh))
        out = np.zeros((len(texts), len(self.net.langs)))
        for i, words in enumerate(split):
            if words:
                out[i] = self.sums[[rows[w] for w in words]].sum(axis=0) / (sum(map(len, words)) + len(words))
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        good = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
        langs, scores = [UND] * len(texts), [0.0] * len(texts)
        pooled = self.pool([texts[i] for i in good]).round(5)      # drops the noise of batching
        for i, p in zip(good, pooled):
            k = int(p.argmax())
            langs[i], scores[i] = self.net.langs[k], float(min(1.0, p[k]))
        return langs, scores


def held_out(key: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _below(ends: dict[str, int], place, lang="lang"):
    """Rows whose place is at most their language's end."""
    table = F.create_map(*[F.lit(x) for kv in sorted(ends.items()) for x in kv])
    return place <= table[F.col(lang)]


def training_sample(docs: DataFrame, key="doc_id", text="text", lang="lang", limit: int = SAMPLE_DOCS) -> DataFrame:
    """``lang, place, text`` of up to ``limit`` labelled documents per language that are not
    held out: those with the smallest places (hashes of id and text)."""
    place = hash01(F.col(key), F.xxhash64(F.col(text)))
    rows = (docs.filter(~held_out(key) & F.col(lang).isNotNull() & F.col(text).isNotNull())
                .select(F.col(lang).alias("lang"), place.alias("place"), F.col(text).alias("text")))
    # places alone find the last one of each language; copies of a row have one place
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("place").alias("n")).collect()
    if not sizes:
        return rows
    thin = {r["lang"]: int(2 ** 52 * min(1.0, (1.5 * limit + 50) / r["n"])) for r in sizes}
    found: dict[str, list[int]] = {}
    for r in rows.filter(_below(thin, F.col("place"))).select("lang", "place").distinct().collect():
        found.setdefault(r["lang"], []).append(r["place"])         # about 1.5 x limit a language
    ends = {k: sorted(v)[:limit][-1] for k, v in found.items()}
    return rows.filter(_below(ends, F.col("place"))).groupBy("lang", "place").agg(F.min("text").alias("text"))


def training_pieces(docs: DataFrame, key="doc_id", text="text", lang="lang", limit: int = SAMPLE_DOCS,
                    most: int = SAMPLE_PIECES) -> dict[str, Counter]:
    """The counted pieces of the training sample's whole texts, about ``most`` per language."""
    def count(batches):
        import pyarrow as pa

        for batch in (part for whole in batches for part in portions(whole, "text")):
            got = count_pieces(zip(batch.column(1).to_pylist(), batch.column(0).to_pylist()))
            rows = [(k, p, n) for k, own in got.items() for p, n in own.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()),
                                              pa.array([r[1] for r in rows], pa.binary()),
                                              pa.array([r[2] for r in rows], pa.int64())], ["lang", "piece", "n"])

    sample = training_sample(docs, key, text, lang, limit).select("lang", "text")
    counts = (sample.mapInArrow(count, "lang string, piece binary, n long")
                    .groupBy("lang", "piece").agg(F.sum("n").alias("n")))
    counts = materialize(counts.withColumn("place", hash01(F.xxhash64("piece"))), "language-pieces")
    ends = {r["lang"]: int(2 ** 52 * min(1.0, most / r["n"])) for r in counts.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    words: dict[str, Counter] = {k: Counter() for k in ends}
    if ends:
        for r in counts.filter(_below(ends, F.col("place"))).collect():       # about most x languages rows
            words[r["lang"]][bytes(r["piece"])] = r["n"]
    return words


def identify(docs: DataFrame, net: Net | None, text: str = "text", drop: tuple = ()) -> DataFrame:
    """Add ``lang_pred`` and ``score``."""
    reader: list[Reader] = []          # one per task, filled on first use

    def run(texts):
        if net is None:
            return {"lang_pred": [UND] * len(texts), "score": [0.0] * len(texts)}
        if not reader:
            reader.append(Reader(net))
        langs, scores = reader[0].predict(texts)
        return {"lang_pred": langs, "score": scores}

    return map_text(docs, run, "lang_pred string, score double", text, drop=drop)
