"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes.

The field is trained from the small labelled table below and decoded by Viterbi for many sequences at once. It reads the
words near a digit or an ``@``: an entity has one of them, so all other words are outside of entities.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadstream.llm.common import slices

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")
STATES = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
REACH = 3
EPOCHS = 250
# Sequences are decoded together as long as they have no more words than this, with padding; their emissions take 6 MB.
WORDS_A_BATCH = 1 << 16
# Emissions of so many feature rows are remembered at a time.
MOST_KNOWN = 1 << 16

# The labelled table: entities in brackets after their kind. Digits and letters are varied in training.
LABELLED = """
write to {email jane.doe@mail.example.com} before noon
contact {email info@firm.example} or come by
und {email k.lang@post.example.org} geiever
mail me at {email sam_w99@box7.example.net} please
Send: {email a.b@c.example} .
the host {ip 10.24.3.117} did not answer
ping {ip 192.168.100.4} from here
from {ip 8.14.200.31} to {ip 9.99.1.250} in the log
charged to {card 4539578763621486} last week
card {card 4539 5787 6362 1486} was declined
pay with {card 5425-2334-3010-9903} now
eran {card 5105105105105100} ndatly on
call {phone +1 (212) 555-0147} today
and {phone +1 (305) 555-7781} the thin of
tel. {phone +49 30 9018 2200} oder
reach us on {phone +44 20 7946 0991} or by mail
ring {phone (212) 555-0147} after six
or dial {phone 212-555-0193} instead
phone: {phone 030-555-0199} ext
the erti token = {secret 04dbebab91ab85687d33eeaaf9ac699e1188f962} of
with token = {secret cb1a9fee807a05366fcb8b6c95c7c565} in it
onti token = {secret 9f86d081884c7d659a2feaa0c55ad015a3bf4f1b} re.
api_key = {secret f3ef4d6b2755a36d7d9c25bd72c4d5f67e06aa10} here
password = {secret 7b3d979ca8330a94fa7e9e1b466d8b99} set
secret: {secret 1c383cd30b7c298ab50293adfecb7b18ab50293a} end
under the Apache License, Version 2.0. You may
the 2.0 release and the 3.1.4 patch of 2019
see section 4.2.1 on page 117 for more
1. The first of 12 rules is short
about 3,500 units were sold in 1998 for 12.50 each
on 2021-03-14 at 10:45 we met 14 people
from 1939-1945 some 60 000 men
version 10.4.2 build 20190304 is out
a ratio of 16:9 or 0.75 in 80% of cases
ISBN 978 and pages 200-215 of volume 7
chapter 9. in the year 2024. of
follow @someone and @other on the web
2 of 3 at 5 pm in room 101b
the thin of that 42 nd 7 ering
in der 3. Auflage von 1987 und 12 mehr
article 5 of 27 April 2016, no 679
commit 3f2a9c1 fixed it and build 88 passed
"""

_CLASS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is taken whole, from its start: giving digits back can't make the next dot match.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
# What parts long words; the signs that occur within entities do not.
_PART = re.compile(r"""[^,;:=|&?"'`<>{}\[\]]+""")
LONG_WORD = 64
_TRIGGER = re.compile(r"[0-9@]")
_HEX = re.compile(r"[0-9a-fA-F]{20,}")
_OUTER_LEFT, _OUTER_RIGHT = "\"'<[{", ".,;:!?%$&*#\"'>]}"
Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) of the four fixed patterns, by start and kind; offsets count code points."""
    found: list[Span] = []
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _CLASS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            found.append((start, 0, free))
        at = text.find("@", at + 1 if not domain else free)
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(_DIGIT.findall(m.group())) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def _core(word: str) -> str:
    return word.lstrip(_OUTER_LEFT).rstrip(_OUTER_RIGHT)


def _shape(word: str) -> str:
    short = re.sub(r"[0-9]", "9", word)
    short = re.sub(r"[A-Z]+", "A", re.sub(r"[^\W\d_A-Z]+", "a", short))
    return re.sub(r"9{5,}", lambda m: "9{" + str(min(20, len(m.group()) // 4 * 4)) + "}", short)


def word_features(words: list[str]) -> list[list[str]]:
    cores = [_core(w) or w for w in words]
    shapes = [_shape(c) for c in cores]
    kinds = [re.sub(r"(.)\1+", r"\1", re.sub(r"9\{\d+\}", "9", s)) for s in shapes]
    out = []
    for i, core in enumerate(cores):
        digits = len(_DIGIT.findall(core))
        before, earlier = (words[i - 1].lower() if i else "^"), (words[i - 2].lower() if i > 1 else "^")
        row = ["1", "s=" + shapes[i], "k=" + kinds[i], f"d={min(digits, 16) // 2}", f"l={min(len(core), 48) // 8}"]
        row += ["p=" + (kinds[i - 1] if i else "^"), "n=" + (kinds[i + 1] if i + 1 < len(words) else "$")]
        row += ["=before" if before in ("=", ":") or before.endswith((":", "=")) else "no=", f"k={kinds[i]},p={kinds[i - 1] if i else '^'}"]
        if before == "=":
            row.append("named=" + earlier)
        if _HEX.fullmatch(core):
            row.append("hex")
        for sign in "@+(-.:,/":
            if sign in core:
                row.append("has" + sign)
        if core.count(".") == 3 and digits >= 4:
            row.append("dots3")
        if not digits and "@" not in core:
            row.append("plain")
        out.append(row)
    return out


@dataclass
class Field:
    index: dict[str, int]
    emission: np.ndarray  # features x states
    transition: np.ndarray  # states x states
    first: np.ndarray


def labelled_sequences() -> list[tuple[list[str], list[int]]]:
    """The labelled table as words and states, and two more of each line with other digits and letters."""
    rng = np.random.default_rng(11)
    out = []
    for line in LABELLED.strip().split("\n"):
        for copy in range(3):
            words, states = [], []
            for part in re.findall(r"\{\w+ [^}]*\}|[^{}]+", line):
                kind = part[1:].split(" ", 1)[0] if part[0] == "{" else None
                own = (part[1:-1].split(" ", 1)[1] if kind else part).split()
                for i, word in enumerate(own):
                    if copy and (kind or rng.random() < 0.7):
                        word = re.sub(r"[0-9]", lambda m: str(rng.integers(1, 10)), word)
                        if kind == "secret":
                            word = "".join(rng.choice(list("0123456789abcdef"), rng.choice([32, 36, 40])))
                        elif kind == "email":
                            word = "".join(chr(97 + rng.integers(26)) if c.isalpha() else c for c in word)
                        elif kind == "ip":
                            word = ".".join(str(rng.integers(1, 256)) for _ in range(4))
                    words.append(word)
                    states.append(0 if kind is None else STATES.index(("I-" if i else "B-") + kind))
            out.append((words, states))
    return out


def train(epochs: int = EPOCHS) -> Field:
    """Maximum likelihood with a quadratic penalty, by Adam on all sequences at once; forward-backward in log space."""
    rows = labelled_sequences()
    features = [word_features(w) for w, _ in rows]
    index = {f: i for i, f in enumerate(sorted({f for r in features for w in r for f in w}))}
    longest, n, s = max(len(w) for w, _ in rows), len(rows), len(STATES)
    x = np.zeros((n, longest, len(index)))
    y, live = np.zeros((n, longest), int), np.zeros((n, longest), bool)
    for i, (r, (_, states)) in enumerate(zip(features, rows)):
        for t, w in enumerate(r):
            x[i, t, [index[f] for f in w]] = 1
        y[i, : len(states)], live[i, : len(states)] = states, True
    flat = x.reshape(-1, len(index))
    params = [np.zeros((len(index), s)), np.zeros((s, s)), np.zeros(s)]
    moment = [[np.zeros_like(p), np.zeros_like(p)] for p in params]
    one = np.eye(s)
    both = live[:, 1:, None, None]
    seen = [flat.T @ (one[y] * live[..., None]).reshape(-1, s), (one[y[:, :-1]][..., :, None] * one[y[:, 1:]][..., None, :] * both).sum((0, 1)), one[y[:, 0]].sum(0)]

    def lse(a: np.ndarray, axis: int) -> np.ndarray:
        top = a.max(axis, keepdims=True)
        return np.log(np.exp(a - top).sum(axis)) + top.squeeze(axis)

    for step in range(1, epochs + 1):
        e = (flat @ params[0]).reshape(n, longest, s)
        alpha, beta = np.zeros((n, longest, s)), np.zeros((n, longest, s))
        alpha[:, 0] = params[2] + e[:, 0]
        for t in range(1, longest):
            alpha[:, t] = np.where(live[:, t, None], lse(alpha[:, t - 1, :, None] + params[1], 1) + e[:, t], alpha[:, t - 1])
        for t in range(longest - 2, -1, -1):
            beta[:, t] = np.where(live[:, t + 1, None], lse(params[1][None] + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2), 0)
        whole = lse(alpha[:, -1], 1)
        single = np.exp(alpha + beta - whole[:, None, None]) * live[..., None]
        pairs = np.exp(alpha[:, :-1, :, None] + params[1] + (e[:, 1:] + beta[:, 1:])[:, :, None, :] - whole[:, None, None, None]) * both
        hoped = [flat.T @ single.reshape(-1, s), pairs.sum((0, 1)), single[:, 0].sum(0)]
        for p, (m, v), got, want in zip(params, moment, seen, hoped):
            g = (want - got) / n + 0.002 * p
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    transition = params[1].copy()
    for i, a in enumerate(STATES):
        for j, b in enumerate(STATES):
            if b[0] == "I" and a[1:] != b[1:]:
                transition[i, j] = -1e9
    first = np.where([a[0] == "I" for a in STATES], -1e9, params[2])
    return Field(index, params[0], transition, first)


def _scores(field: Field, words: list[str], start: int, stop: int, known: dict[tuple, np.ndarray]) -> np.ndarray:
    """The emissions of the words from start to stop; features look two words back and one ahead."""
    left = max(start - 2, 0)
    rows = word_features(words[left : stop + 1])[start - left : stop - left]
    out = np.empty((len(rows), len(STATES)))
    for t, row in enumerate(rows):
        key = tuple(row)
        if key not in known:
            if len(known) >= MOST_KNOWN:
                known.clear()
            known[key] = field.emission[[field.index[f] for f in row if f in field.index]].sum(0)
        out[t] = known[key]
    return out


def _decoded(field: Field, sequences: list[list[str]], known: dict[tuple, np.ndarray]) -> list[np.ndarray]:
    """The best states of sequences of similar length. Emissions are held for a block of steps, only back-pointers for all."""
    lengths = np.array([len(w) for w in sequences])
    longest, n, s = int(lengths.max()), len(sequences), len(STATES)
    back = np.zeros((n, longest, s), np.int8)
    best = np.zeros((n, s))
    steps = max(1, WORDS_A_BATCH // n)
    for at in range(0, longest, steps):
        score = np.zeros((n, min(steps, longest - at), s))
        for i, words in enumerate(sequences):
            if at < len(words):
                own = _scores(field, words, at, min(at + steps, len(words)), known)
                score[i, : len(own)] = own
        for t in range(at, at + score.shape[1]):
            if not t:
                best = field.first + score[:, 0]
                continue
            ways = best[:, :, None] + field.transition
            live = (t < lengths)[:, None]
            back[:, t] = np.where(live, ways.argmax(1), np.arange(s))
            best = np.where(live, ways.max(1) + score[:, t - at], best)
    states = np.zeros((n, longest), np.int8)
    states[:, -1] = best.argmax(1)
    for t in range(longest - 1, 0, -1):
        states[:, t - 1] = back[np.arange(n), t, states[:, t]]
    return [states[i, :k] for i, k in enumerate(lengths)]


def viterbi(field: Field, sequences: list[list[str]]) -> list[np.ndarray]:
    """The best states of each sequence of words; the steps run over sequences of similar length together."""
    out: list[np.ndarray] = [np.zeros(0, np.int8)] * len(sequences)
    known: dict[tuple, np.ndarray] = {}
    order = sorted((i for i, w in enumerate(sequences) if w), key=lambda i: len(sequences[i]))
    while order:
        # From the longest down, as many as fit when all are padded to it; a longer one goes alone.
        some = order[-max(1, WORDS_A_BATCH // len(sequences[order[-1]])) :]
        del order[-len(some) :]
        for i, path in zip(some, _decoded(field, [sequences[i] for i in some], known)):
            out[i] = path
    return out


def _tokens(start: int, word: str) -> list[tuple[int, str]]:
    """A word with its place; a long one, such as a line of JSON without spaces, in the parts between its punctuation."""
    if len(word) <= LONG_WORD:
        return [(start, word)]
    return [(start + m.start(), m.group()) for m in _PART.finditer(word)]


def islands(text: str) -> list[list[tuple[int, str]]]:
    """The words within reach of a digit or an ``@``, with their places; near ones together."""
    words = [x for m in _WORD.finditer(text) for x in _tokens(m.start(), m.group())]
    out: list[list[tuple[int, str]]] = []
    until = -1
    for i, (_, word) in enumerate(words):
        if _TRIGGER.search(word):
            start = max(i - REACH, until, 0)
            stop = min(i + REACH + 1, len(words))
            if start < until or (out and start == until):
                out[-1] += words[until:stop]
            else:
                out.append(words[start:stop])
            until = max(until, stop)
    return out


def _plausible(kind: str, text: str) -> bool:
    """The fixed limits of a kind hold for the field's entities too: a number that fails its checksum is no card."""
    digits = "".join(_DIGIT.findall(text))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "ip":
        parts = [p.lstrip("0") for p in text.split(".")]
        return _IP.fullmatch(text) is not None and all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)
    return kind != "email" or "@" in text


def added_spans(field: Field, texts: list[str], base: list[list[Span]]) -> list[list[Span]]:
    """Entities of the field that touch no base span, hold a digit or an ``@``, and keep the limits of their kind."""
    own = [islands(t) for t in texts]
    paths = iter(viterbi(field, [[w for _, w in island] for rows in own for island in rows]))
    out = []
    for text, rows, taken in zip(texts, own, base):
        found: list[Span] = []
        for island in rows:
            path = next(paths)
            i = 0
            while i < len(path):
                label = STATES[path[i]]
                if label[0] != "B":
                    i += 1
                    continue
                j = i + 1
                while j < len(path) and STATES[path[j]] == "I" + label[1:]:
                    j += 1
                (a, first), (b, last) = island[i], island[j - 1]
                start, end = a + len(first) - len(first.lstrip(_OUTER_LEFT)), b + len(last.rstrip(_OUTER_RIGHT))
                if end > start and _TRIGGER.search(text, start, end) and _plausible(label[2:], text[start:end]) and all(e <= start or s >= end for s, _, e in taken):
                    found.append((start, KINDS.index(label[2:]), end))
                i = j
        out.append(found)
    return out


def written_out(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """Spans that overlap are replaced as one, by the first one's kind."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind]}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def detect(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """All given columns with doc_id and text, and n_email, n_ip, n_card, n_phone, base_sha256, spans, redacted.

    Counts and digest are of the base patterns; ``spans`` has those of the field too, and ``redacted`` the text with all
    replaced by their kind. Null texts are read as empty (and stay null in ``redacted``). Rows that repeat give the same.
    Given columns of these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field or train())
    added = ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "redacted")
    kept = docs.drop(*added)
    names = kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                column = part.column(part.schema.get_field_index("text"))
                texts = pc.fill_null(column, "").to_pylist()
                counts = np.zeros((len(texts), 4), np.int64)
                digest = [hashlib.sha256(b"").hexdigest()] * len(texts)
                spans, cleaned = [""] * len(texts), column.to_pylist()
                some = [i for i, t in enumerate(texts) if _TRIGGER.search(t)]
                base = [base_spans(texts[i]) for i in some]
                for i, own, more in zip(some, base, added_spans(shared.value, [texts[i] for i in some], base)):
                    for _, kind, _ in own:
                        counts[i, kind] += 1
                    digest[i] = hashlib.sha256(written_out(own).encode()).hexdigest()
                    spans[i] = written_out(both := sorted(own + more))
                    if both:
                        cleaned[i] = redacted(texts[i], both)
                columns = [*(pa.array(counts[:, k]) for k in range(4)), *(pa.array(c, pa.string()) for c in (digest, spans, cleaned))]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=[*names, *added])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(run, f"{fields}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, redacted string")


def find_spans(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """``detect`` without the text."""
    return detect(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), field).drop("text", "redacted")
