"""Secret scan: rules find the base spans, a character network judges every candidate in its context."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitepulse.llm.common import add_columns, dropped, lower_ascii, map_batches, stored
from sitepulse.llm.learning import STEPS, averaged, scale, steps

# The base patterns. Matches are as long as possible and those that are too short are
# dropped afterwards, so that a failing match still uses up its characters.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run is matched whole, so short ones can be left out here
KINDS = ("assign", "access", "hex", "net")
_KEYWORDS = ("passw", "secret", "token", "api")
#: What may be a secret: a run of key characters with a digit and a letter.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_DIGIT, _LETTER = re.compile(r"[0-9]"), re.compile(r"[A-Za-z]")
#: Characters of the context on either side, and of a part of the candidate; a longer one has several parts.
SIDE, BODY = 24, 48
LENGTH = 2 * SIDE + BODY
#: The alphabet: 0 for an empty place, ASCII as is, all others as one.
ALPHABET = 129
WIDTHS = (3, 5)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base rules, leftmost and non-overlapping within a kind."""
    found: list[tuple[int, int, str]] = []
    low = lower_ascii(text)
    if any(word in low for word in _KEYWORDS):
        found += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return found


def candidates(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in CANDIDATE.finditer(text) if _DIGIT.search(m[0]) and _LETTER.search(m[0])]


def _codes(left: str, body: str, right: str) -> np.ndarray:
    line = f"{left[-SIDE:]:>{SIDE}}{body:\x00<{BODY}}{right[:SIDE]:<{SIDE}}"
    codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.minimum(codes, ALPHABET - 1).astype(np.uint8)


def parts(left: str, body: str, right: str) -> list[np.ndarray]:
    """Character codes of a candidate in its context, part by part.

    Parts overlap by as much as the widest filter needs, so together they show every run of characters.
    """
    overlap = max(WIDTHS) - 1
    return [_codes(left, body[at : at + BODY], right) for at in range(0, max(len(body) - overlap, 1), BODY - overlap)]


def parts_of(text: str, start: int, end: int) -> list[np.ndarray]:
    return parts(text[max(0, start - SIDE) : start], text[start:end], text[end : end + SIDE])


@dataclass
class CharCnn:
    """Embedded characters, filters of two widths, pooling over the candidate and over each side, logistic output."""

    size: int = 8
    filters: int = 12
    seed: int = 11
    scale: tuple[float, float] = (1.0, 0.0)
    threshold: float = 1.1  # nothing is added before training
    weights: dict[str, np.ndarray] = field(init=False)

    def __post_init__(self) -> None:
        rng = np.random.default_rng(self.seed)
        n = len(WIDTHS) * self.filters * 3
        self.weights = {
            "table": rng.normal(0, 0.3, (ALPHABET, self.size)),
            **{f"bank{w}": rng.normal(0, 1 / np.sqrt(w * self.size), (w * self.size, self.filters)) for w in WIDTHS},
            **{f"bias{w}": np.zeros(self.filters) for w in WIDTHS},
            "out": rng.normal(0, 1 / np.sqrt(n), n),
            "out_bias": np.zeros(1),
        }

    def row(self) -> np.ndarray:
        """All weights in a row."""
        return np.concatenate([v.ravel() for v in self.weights.values()])

    def take(self, row: np.ndarray) -> None:
        """Set all weights from those in a row."""
        at = 0
        for k, v in self.weights.items():
            self.weights[k] = row[at : at + v.size].reshape(v.shape).copy()
            at += v.size

    @staticmethod
    def _zones(w: int) -> list[slice]:
        """Windows that lie in the left context, touch the candidate, lie in the right context."""
        return [slice(0, SIDE - w + 1), slice(SIDE - w + 1, SIDE + BODY), slice(SIDE + BODY, LENGTH - w + 1)]

    def _forward(self, codes: np.ndarray) -> tuple[np.ndarray, dict]:
        p, memory = self.weights, {}
        x = p["table"][codes]
        pooled = []
        for w in WIDTHS:
            view = np.lib.stride_tricks.sliding_window_view(x, w, axis=1).transpose(0, 1, 3, 2)
            flat = view.reshape(len(codes), LENGTH - w + 1, w * self.size)
            z = flat @ p[f"bank{w}"] + p[f"bias{w}"]
            tops = []
            for zone in self._zones(w):
                top = z[:, zone].argmax(axis=1)
                tops.append(top + zone.start)
                pooled.append(np.take_along_axis(z[:, zone], top[:, None], 1)[:, 0])
            memory[w] = (flat, tops)
        found = np.concatenate(pooled, axis=1)
        memory["pooled"] = found
        return np.maximum(found, 0) @ p["out"] + p["out_bias"][0], memory

    def logits(self, codes: np.ndarray) -> np.ndarray:
        # Few at a time, so that their windows stay in the processor's cache.
        parts = [self._forward(codes[at : at + 64])[0] for at in range(0, len(codes), 64)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def score(self, codes: np.ndarray) -> np.ndarray:
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a * self.logits(codes) + b, -30, 30)))

    def score_whole(self, candidates: list[list[np.ndarray]]) -> np.ndarray:
        """A score per candidate: the highest of its parts."""
        if not candidates:
            return np.zeros(0)
        sizes = np.array([len(c) for c in candidates])
        scores = self.score(np.stack([p for c in candidates for p in c]))
        return np.maximum.reduceat(scores, np.cumsum(sizes) - sizes)

    def fit(self, codes: np.ndarray, labels: np.ndarray, rounds: int = 10, batch: int = 64, rate: float = 0.05) -> None:
        rng = np.random.default_rng(self.seed)
        p = self.weights
        seen = {k: np.full(v.shape, 1e-2) for k, v in p.items()}
        share = labels.mean() if len(labels) else 0.5
        weight = np.where(labels > 0, 0.5 / max(share, 1e-3), 0.5 / max(1 - share, 1e-3))
        for _ in range(rounds):
            order = rng.permutation(len(codes))
            for at in range(0, len(order), batch):
                some = order[at : at + batch]
                z, memory = self._forward(codes[some])
                d = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[some]) * weight[some] / len(some)
                pooled = memory["pooled"]
                grads = {k: np.zeros_like(v) for k, v in p.items()}
                grads["out"] = np.maximum(pooled, 0).T @ d
                grads["out_bias"][0] = d.sum()
                back = d[:, None] * p["out"] * (pooled > 0)
                k = 0
                lines = np.arange(len(some))[:, None]
                cells, shares = [], []
                for w in WIDTHS:
                    flat, tops = memory[w]
                    turned = np.ascontiguousarray(p[f"bank{w}"].T)
                    for top in tops:
                        own = back[:, k : k + self.filters]
                        k += self.filters
                        grads[f"bias{w}"] += own.sum(axis=0)
                        won = flat[lines, top]  # (texts, filters, w * size)
                        grads[f"bank{w}"] += np.einsum("nf,nfd->df", own, won)
                        # Filters that found nothing share in nothing.
                        some_lines, some_filters = np.nonzero(own)
                        first, lines_of = top[some_lines, some_filters], some[some_lines]
                        spread = own[some_lines, some_filters, None] * turned[some_filters]
                        for j in range(w):
                            cells.append(codes[lines_of, first + j])
                            shares.append(spread[:, j * self.size : (j + 1) * self.size])
                at_table = np.concatenate(cells).astype(np.int64)[:, None] * self.size + np.arange(self.size)
                grads["table"] += np.bincount(at_table.ravel(), np.concatenate(shares).ravel(), ALPHABET * self.size).reshape(ALPHABET, self.size)
                for name, g in grads.items():
                    seen[name] += g * g
                    p[name] -= rate * g / np.sqrt(seen[name])

    def calibrate(self, logits: np.ndarray, labels: np.ndarray, recall: float, n: np.ndarray | None = None) -> None:
        """Scale the score, then take the highest threshold that still finds ``recall`` of the labelled secrets.

        It is set in the middle of the gap below that secret, up to the next other candidate. There are ``n`` rows of each kind.
        """
        n = np.ones(len(logits), np.int64) if n is None else n
        a, b = self.scale = scale(logits, labels, n)
        good = np.sort(logits[labels > 0])
        if len(good):
            sums = np.cumsum(n[labels > 0][np.argsort(logits[labels > 0], kind="stable")])
            reached = float(good[np.searchsorted(sums, int((1 - recall) * sums[-1]), "right")])
            below = logits[(labels == 0) & (logits < reached)]
            middle = (reached + below.max()) / 2 if len(below) else logits.min()
            self.threshold = float(1 / (1 + np.exp(-np.clip(a * middle + b, -30, 30))))


# --- training ------------------------------------------------------------------------------

_ALNUM = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
# Beginnings that services give their keys, with the length of the rest, and words before a value.
_VENDORS = (("ghp_", 36), ("gho_", 36), ("xoxb-", 48), ("xoxp-", 48), ("AIza", 35), ("sk_live_", 24), ("glpat-", 20), ("npm_", 36))
_CUES = ("key: ", "key=", "Bearer ", "pwd: ", "credential ", "auth=", "private_key = ", "use ", "the code is ", '"', "= ")
_KEYS = ("password", "passwd", "secret", "token", "api_key", "apikey", "Password", "TOKEN", "API_KEY")
_PLAIN_CUES = ("id: ", "id=", "see ", "file ", "path: ", "ref ", "name=", "at ", "the page is ", '"', "= ")
#: Whether a code point is white space; the last entry stands for all higher ones.
_SPACE = np.array([chr(i).isspace() for i in range(0x3002)])
SECRET_SHAPES = ("jwt", "vendor", "base64", "pem", "mixed")
#: Shapes that the rules know, of which texts alone hold too few to learn from.
BASE_SHAPES = ("assign", "access", "hex")
PLAIN_SHAPES = ("uuid", "path", "identifier", "slug", "stamp")
#: Made examples of either label per document, and long words of a text among the negatives.
MADE, LONG_WORDS = 2, 8
#: Parts that the network is fitted on at least; fewer come several times.
LEAST_PARTS, MOST_ROUNDS = 50_000, 10
#: Rates of the first half of the texts, and of the second, which goes on from the weights that the first has reached.
RATES = (0.05, 0.02)


def made_secret(shape: str, rng: np.random.Generator) -> str:
    """A made-up secret of a shape."""

    def some(letters: str, least: int, most: int) -> str:
        return "".join([letters[i] for i in rng.integers(0, len(letters), rng.integers(least, most + 1)).tolist()])

    if shape == "jwt":
        return "eyJ" + some(_ALNUM + "-_", 24, 120)
    if shape == "vendor":
        start, size = _VENDORS[rng.integers(len(_VENDORS))]
        return start + some(_ALNUM + ("-" if start.startswith("xox") else ""), size, size)
    if shape == "base64":
        return some(_ALNUM + "+/", 22, 86) + "=" * int(rng.integers(3))
    if shape == "pem":
        return some(_ALNUM + "+/", 64, 64)
    if shape == "access":
        return "AKIA" + some("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 16, 20)
    if shape == "hex":
        return some("0123456789abcdef", 24, 64)
    if shape == "assign":
        return some(_ALNUM[26:] if rng.random() < 0.5 else _ALNUM + "+/_.=-", 6, 32)
    return some(_ALNUM, 16, 40)


def made_plain(shape: str, words: list[str], rng: np.random.Generator) -> str:
    """A made-up string that looks like a candidate but is none, of words of the text where the shape has words."""

    def word() -> str:
        return words[rng.integers(len(words))] if words else "item"

    def number(most: int) -> str:
        return str(rng.integers(1, most))

    if shape == "uuid":
        digits = "".join(rng.choice(list("0123456789abcdef"), 32))
        found = "-".join(digits[a:b] for a, b in ((0, 8), (8, 12), (12, 16), (16, 20), (20, 32)))
        return found.upper() if rng.random() < 0.3 else found
    if shape == "stamp":
        return f"20{rng.integers(10, 40)}-{rng.integers(10, 13)}-{rng.integers(10, 29)}T{rng.integers(10, 24)}-{number(60)}-{number(60)}Z"
    joint = {"path": "/", "slug": "-", "identifier": "_"}[shape]
    pieces = [word() for _ in range(rng.integers(2, 7))]
    if shape == "identifier" and rng.random() < 0.5:
        pieces, joint = [p.capitalize() for p in pieces], ""
    pieces[rng.integers(len(pieces))] += number(3000)
    found = joint.join(pieces)
    return ("/" if shape == "path" else "") + found + ("" if len(found) >= 16 else joint + word() * 3)


Example = tuple[str, str, str, int, str]


def examples(text: str) -> list[Example]:
    """(left, body, right, label, kind) of a text: what the rules find, made secrets, candidates and long words apart.

    Half of the assigned values that are candidates lose the words before them, so the network can't just learn the rule
    back. Made secrets and made plain strings stand between words of the text, with and without a cue; only made
    values of assignments have a key word before them. All draws hang on the text.
    """
    rng = np.random.default_rng(xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace")))
    base = base_spans(text)
    found: list[Example] = []

    def around(start: int, end: int) -> tuple[str, str]:
        return text[max(0, start - SIDE) : start], text[end : end + SIDE]

    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    gaps = np.flatnonzero(_SPACE[np.minimum(points, len(_SPACE) - 1)])
    spaces = gaps if len(gaps) else np.zeros(1, np.int64)
    for start, end, kind in base:
        if kind == "assign":
            start = ASSIGN.match(text, start).start(2)
        left, right = around(start, end)
        if kind == "assign" and candidates(text[start:end]) and rng.random() < 0.5:
            at = spaces[rng.integers(len(spaces))]
            left = text[max(0, at - SIDE) : at] + " "
        found.append((left, text[start:end], right, 1, kind))
    starts, ends = np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(text)]])
    wide = ends - starts >= 12
    long_words = list(zip(starts[wide].tolist(), ends[wide].tolist()))
    order = sorted(long_words, key=lambda span: xxhash.xxh3_64_intdigest(f"{span}{text[span[0]:span[1]]}".encode("utf-8", "replace")))
    # A candidate lies in one long word.
    asked = [(a + s, a + e) for a, b in long_words if b - a >= 16 for s, e in candidates(text[a:b])]
    for start, end in dict.fromkeys(asked + order[:LONG_WORDS]):
        if all(end <= s or start >= e for s, e, _ in base):
            found.append((*around(start, end)[:1], text[start:end], around(start, end)[1], 0, "text"))
    words = re.findall(r"[A-Za-z]{3,12}", text[:20_000])
    for _ in range(MADE):
        for label, shapes, cues in ((1, SECRET_SHAPES + BASE_SHAPES, _CUES), (0, PLAIN_SHAPES, _PLAIN_CUES)):
            shape = shapes[rng.integers(len(shapes))]
            body = made_secret(shape, rng) if label else made_plain(shape, words, rng)
            if shape not in BASE_SHAPES and (candidates(body) != [(0, len(body))] or base_spans(body)):
                continue  # the network is never asked about it
            at = spaces[rng.integers(len(spaces))]
            left, right = text[max(0, at - SIDE) : at] + " ", text[at : at + SIDE]
            if shape == "assign":
                left += _KEYS[rng.integers(len(_KEYS))] + ("=", ": ", " = ", '": "')[rng.integers(4)]
            elif rng.random() < 0.5:
                left += cues[rng.integers(len(cues))]
            found.append((left, body, right, label, shape))
    return found


def train(docs: DataFrame, rows: int = 8_192, recall: float = 0.98) -> CharCnn:
    """Fit on the labelled examples of all documents, in blocks of about ``rows`` side by side whose weights are averaged, half by half.

    Equal texts count once. A third of the texts, by a hash, is kept for the scale and the threshold, from the
    counts of all its logits. Blocks are dealt by a hash too, so they don't hang on how the table is spread.
    Without both kinds the network stays untrained and adds nothing.
    """

    def work(batch: dict) -> dict:
        out = [[(p, e[3]) for e in examples(t) for p in parts(*e[:3])] for t in batch["text"]]
        codes = [np.concatenate([p for p, _ in found]).tobytes() if found else b"" for found in out]
        return {
            "key": [xxhash.xxh3_64_intdigest(c) - (1 << 63) for c in codes],
            "labels": [bytes(y for _, y in found) for found in out],
            "codes": codes,
        }

    texts = docs.selectExpr("cast(text as string) text").where("text IS NOT NULL")
    made = map_batches(texts, work, "key bigint, labels binary, codes binary").where("length(labels) > 0")
    table = stored(made.distinct(), "secrets-examples")
    count, *ends = table.agg(
        F.count(F.lit(1)),
        F.max(F.instr(F.hex("labels"), "00") > 0),
        F.max(F.instr(F.hex("labels"), "01") > 0),
        F.sum(F.length("labels")),
    ).first()
    model = CharCnn()
    if not count or not all(ends[:2]):
        dropped(table)
        return model
    names = list(model.weights)
    rounds = min(MOST_ROUNDS, max(1, -(-LEAST_PARTS // ends[2])))
    shards = -(-count // (len(RATES) * rows))
    # The same hash deals the rows, so a shard is one partition.
    shard = F.pmod(F.hash("key"), F.lit(shards)).alias("shard")
    for half, rate in enumerate(RATES):
        start = model.row()

        def fit(columns: list[list], start: np.ndarray = start, rate: float = rate) -> tuple[np.ndarray, np.ndarray, int]:
            own = CharCnn()
            own.take(start)
            codes = np.frombuffer(b"".join(columns[2]), np.uint8).reshape(-1, LENGTH)
            own.fit(codes, np.frombuffer(b"".join(columns[1]), np.uint8).astype(float), rounds, rate=rate)
            return own.row(), np.ones(len(start), bool), len(codes)

        some = table.where("pmod(key, 3) <> 2").where(F.pmod(F.xxhash64("key"), F.lit(len(RATES))) == half)
        dealt = some.repartition(shards, "key").sortWithinPartitions(shard, "key").select(shard, "labels", "codes")
        model.take(averaged(dealt, start, rows, fit))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batch: dict) -> dict:
        codes = np.frombuffer(b"".join(batch["codes"]), np.uint8).reshape(-1, LENGTH)
        return {"label": list(b"".join(batch["labels"])), "step": steps(shared.value.logits(codes))}

    counts = map_batches(table.where("pmod(key, 3) = 2").select("labels", "codes"), judge, "label int, step int")
    found = counts.groupBy("label", "step").agg(F.count(F.lit(1)).alias("n")).orderBy("label", "step").collect()
    dropped(table)
    if found:
        y, step, n = (np.array(c) for c in zip(*found))
        model.calibrate(step / STEPS, y.astype(float), recall, n)
    return model


def evaluate(docs: DataFrame, model: CharCnn) -> DataFrame:
    """(kind, label, n, flagged): how many examples of each kind the network takes for secrets, for documents kept apart."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: dict) -> dict:
        found = [e for t in batch["text"] for e in examples(t or "")]
        scores = shared.value.score_whole([parts(*e[:3]) for e in found])
        flagged = (scores >= shared.value.threshold).tolist()
        return {"kind": [e[4] for e in found], "label": [e[3] for e in found], "flagged": flagged}

    rows = map_batches(docs.selectExpr("cast(text as string) text"), work, "kind string, label int, flagged boolean")
    return rows.groupBy("kind", "label").agg(F.count(F.lit(1)).alias("n"), F.count_if("flagged").alias("flagged"))


def scan_text(text: str | None, model: CharCnn | None = None) -> dict:
    """All spans of a text; see ``scan_secrets``."""
    text = text or ""
    base = base_spans(text)
    found = list(base)
    if model is not None and model.threshold <= 1:
        # One that sticks out of a base span is judged as well; one inside is found already.
        more = [(s, e) for s, e in candidates(text) if not any(a <= s and e <= b for a, b, _ in base)]
        scores = model.score_whole([parts_of(text, s, e) for s, e in more])
        found += [(s, e, "net") for (s, e), score in zip(more, scores) if score >= model.threshold]

    def line(spans: list[tuple[int, int, str]]) -> str:
        ordered = sorted(spans, key=lambda x: (x[0], KINDS.index(x[2])))
        return ",".join(f"{kind}:{start}:{end}" for start, end, kind in ordered)

    return {
        **{f"n_{kind}": sum(k == kind for _, _, k in base) for kind in KINDS[:3]},
        "base_sha256": hashlib.sha256(line(base).encode()).hexdigest(),
        "spans": line(found),
    }


def redact(text: str | None, spans: str, mark: str = "[secret]") -> str | None:
    """The text with every span replaced; overlapping spans become one mark."""
    if not text or not spans:
        return text
    merged: list[list[int]] = []
    for start, end in sorted(tuple(map(int, part.split(":")[1:])) for part in spans.split(",")):
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(end, merged[-1][1])
        else:
            merged.append([start, end])
    out, at = [], 0
    for start, end in merged:
        out += [text[at:start], mark]
        at = end
    return "".join(out) + text[at:]


SCHEMA = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"


def scan_secrets(docs: DataFrame, model: CharCnn | None = None) -> DataFrame:
    """One row per row of ``docs`` with the spans of secrets in its whole text, in code points.

    Base spans come from the rules; candidates that lie in none of them and whose score reaches the threshold
    are added as ``net``. A null or empty text has no spans (base_sha256 is then that of the empty text).
    Repeated rows each get their own row; a null id stays null.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: dict) -> dict:
        found = [scan_text(t, shared.value) for t in batch["text"]]
        return {"doc_id": batch["doc_id"]} | {k: [f[k] for f in found] for k in scan_text(None)}

    return map_batches(docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text"), work, SCHEMA)


def redact_documents(docs: DataFrame, model: CharCnn | None = None) -> DataFrame:
    """``docs`` with every found secret in ``text`` replaced by a mark; ``n_chars``, where there is one, follows.

    A null or empty text stays as it is; repeated rows and rows without id each stay; an empty table stays empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: dict) -> dict:
        return {"_redacted": [redact(t, scan_text(t, shared.value)["spans"]) for t in batch["text"]]}

    clean = add_columns(docs, ["text"], work, "_redacted string")
    changed = {"text": F.col("_redacted")}
    if "n_chars" in docs.columns:
        grown = F.length("_redacted") - F.length("text")
        changed["n_chars"] = (F.col("n_chars") + F.coalesce(grown, F.lit(0))).cast(docs.schema["n_chars"].dataType)
    return clean.withColumns(changed).select(*docs.columns)
