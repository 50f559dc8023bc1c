"""Personal data: exact patterns, and a linear-chain conditional random field for what they miss.

Besides the patterns' kinds the field finds secrets, such as tokens and keys, and kinds in forms that the patterns drop.
It labels runs of words that hold a digit or an at sign; all other words are outside by definition, which
cuts a text into short independent chains (a label outside on both sides fixes a chain's ends). Features are the
word's shape and those of its neighbours. It is trained by gradient on a small labelled table made from the rule in
``labelled_table`` and decoded by Viterbi in numpy batches of chains of one length.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
OUTSIDE = 0
#: What the field finds.
FIELD_KINDS = (*KINDS, "secret")
#: Labels: outside, then begin and inside of each kind.
LABELS = ("O", *(f"{side}-{kind}" for kind in FIELD_KINDS for side in "BI"))

# The patterns of the contract, with starts that cannot match stepped over.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_HINT = re.compile(r"[0-9@]")
_END = re.compile(r"[\x20\x09-\x0D]")
_WHITE = " \t\n\x0b\x0c\r"

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    odd = digits[-1::-2]
    even = digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[Span]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield "email", start, domain.end()
            free = domain.end()
        else:
            free = at + 1 if start == at else free
        at = text.find("@", max(at + 1, free if domain else at + 1))


def base_spans(text: str) -> list[Span]:
    """The spans of the patterns, by kind and start; failing matches are dropped without another try."""
    spans = list(_emails(text)) if "@" in text else []
    if _HINT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                spans.append(("ip", m.start(), m.end()))
        for m in _CARD.finditer(text):
            digits = _digits(m.group()) if m.end() - m.start() < 64 else ""
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", m.start(), m.end()))
        for m in _PHONE.finditer(text):
            if 8 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                spans.append(("phone", m.start(), m.end()))
    return spans


# --- the field ------------------------------------------------------------------------


def shape(word: str) -> str:
    """The word with runs of capitals, small letters and digits as A, a and 9 (with their number up to 4 for digits)."""
    word = re.sub(r"[0-9]+", lambda m: "9" * min(len(m.group()), 4), word)
    return re.sub(r"[^\W\d_a-z]+", "A", re.sub(r"[^\W\d_A-Z]+", "a", word))


_EDGE = "\"'()[]{}<>,;:!?*#$%&|"


def features(word: str, before: str, after: str) -> list[str]:
    core = word.strip(_EDGE).rstrip(".")
    digits = _digits(core)
    n = len(digits)
    parts = core.split(".")
    return [
        "bias",
        f"shape={shape(core)}",
        f"digits={n if n < 20 else 20}",
        f"only={digits == core}",
        f"at={core.count('@') if core.count('@') < 3 else 3}",
        f"dots={min(len(parts) - 1, 5)}",
        f"dashes={min(core.count('-'), 4)}",
        f"mail={bool(re.fullmatch(r'[^@]+@[^@]+[.][^@.]+', core))}",
        f"quad={len(parts) == 4 and all(re.fullmatch('[0-9]{1,3}', p) and int(p) <= 255 for p in parts)}",
        f"luhn={13 <= n <= 19 and luhn(digits)}",
        f"hex={re.fullmatch('[0-9a-fA-F]{24,}', core) is not None and n < len(core)}",
        f"key={re.fullmatch('[0-9A-Za-z_-]{16,}', core) is not None and n < len(core)}",
        f"plus={core.startswith('+')}",
        f"bracket={word.startswith('(') and ')' in word}",
        f"before={before.strip(_EDGE + '.').lower()}",
        f"before shape={shape(before)}",
        f"after shape={shape(after)}",
    ]


HEX = "0123456789abcdef"


def labelled_table(copies: int = 40, seed: int = 5) -> list[list[tuple[str, str]]]:
    """Short labelled texts, made by a rule: each kind in several forms and places, and numbers that are none of them."""
    rng = np.random.Generator(np.random.Philox(seed))

    def number(n: int) -> str:
        return "".join(str(d) for d in rng.integers(0, 10, n))

    def card() -> str:
        body = number(15)
        return next(body + str(d) for d in range(10) if luhn(body + str(d)))

    def letters(n: int, alphabet: str) -> str:
        return "".join(alphabet[i] for i in rng.integers(0, len(alphabet), n))

    def tagged(kind: str, words: list[str]) -> list[tuple[str, str]]:
        return [(w, ("B-" if i == 0 else "I-") + kind) for i, w in enumerate(words)]

    def plain(*words: str) -> list[tuple[str, str]]:
        return [(w, "O") for w in words]

    texts = []
    for k in range(copies):
        c, line = card(), number(4)
        area, three, marks = str(rng.integers(200, 999)), "555", ("", "!!", "###", "$$$")[k % 4]
        octets = ".".join(str(x) for x in rng.integers(0, 256, 4))
        mail = f"{'abcdefgh'[k % 8]}{number(2)}.lee@mail{k % 9}.example.org"
        texts += [
            plain("call", "me", "at") + tagged("phone", [f"({area})", f"{three}-{line}"]) + plain("today"),
            plain("phone:") + tagged("phone", [f"{area}-{three}-{line}"]) + plain("or", "write"),
            plain("tel") + tagged("phone", [f"0{area}", f"{three}{line}"]) + plain("now."),
            plain("and") + tagged("phone", ["+1", f"({area})", f"{three}-{line}"]) + plain("then"),
            plain("card") + tagged("card", [c[:4], c[4:8], c[8:12], c[12:]]) + plain("expires"),
            plain("paid", "with") + tagged("card", [c]) + plain("again"),
            plain("the") + tagged("card", ["-".join([c[:4], c[4:8], c[8:12], c[12:]])]) + plain("was", "declined"),
            plain("from") + tagged("ip", [octets]) + plain("on", "port", number(4)),
            plain("server") + tagged("ip", [octets + ","]) + plain("up"),
            plain("mail") + tagged("email", [mail]) + plain("please"),
            plain("by") + tagged("email", [f"<{mail}>,"]) + plain("soon"),
            plain("in", str(rng.integers(1900, 2030)), "about", f"{rng.integers(1, 99)}%", "of", f"{number(3)},{number(3)}"),
            plain("version", f"{k % 7}.{k % 5}", "of", "the", "licence", f"{k % 9}.{k % 4}.{k % 6}."),
            plain("order", number(16 if luhn("1") else 15)[:15], "costs", f"{number(2)}.{number(2)}", "dollars"),
            plain("token", "=") + tagged("secret", [f'"{letters(40, HEX)}"' + marks]) + plain("here"),
            plain("API_KEY:") + tagged("secret", [letters(32, HEX).upper()]) + plain("and", "more"),
            plain("secret", "=") + tagged("secret", [f"'{letters(24, HEX + 'ghijkXYZ')}7'"]) + plain("|"),
            plain("Des") + tagged("phone", ["+1", f"({area})", f"{three}-{line}"]) + tagged("ip", [octets]) + plain("du"),
            plain("los") + tagged("phone", ["+1", f"({area})", f"{three}-{line}"]) + plain(number(16)[:15] + "x", "se"),
            plain("build", letters(7, HEX) + "1", "of", "rev", "a" + number(3), "and", f"x{number(2)}y"),
            plain("it's", f"{rng.integers(1, 12)}:{rng.integers(10, 59)}", "on", f"{rng.integers(10, 28)}/0{rng.integers(1, 9)}/{rng.integers(1990, 2029)}"),
            plain("see", "@user" + number(2), "page", number(3), "line", number(2)),
            plain("id", next(c[:15] + str(d) for d in range(10) if not luhn(c[:15] + str(d))), "and", number(6)),
            plain("score", f"{rng.integers(0, 9)}-{rng.integers(0, 9)}", "in", "2nd", "half", "19", "28"),
        ]
    return texts


def _is_candidate(word: str) -> bool:
    return bool(_HINT.search(word))


def _chains(texts: list[list[tuple[str, str]]]) -> list[tuple[list[list[str]], list[int]]]:
    out = []
    for text in texts:
        words = [w for w, _ in text]
        at = 0
        while at < len(words):
            stop = at
            while stop < len(words) and _is_candidate(words[stop]):
                stop += 1
            if stop > at:
                f = [features(words[i], words[i - 1] if i else "", words[i + 1] if i + 1 < len(words) else "") for i in range(at, stop)]
                out.append((f, [LABELS.index(text[i][1]) for i in range(at, stop)]))
            at = max(stop, at + 1)
    return out


class Field:
    """Weights of features by label, and of steps from label to label; label 0 stands before and after a chain."""

    def __init__(self, names: dict[str, int], weight: np.ndarray, step: np.ndarray):
        self.names, self.weight, self.step = names, weight, step

    def emissions(self, chain: list[list[str]]) -> np.ndarray:
        names = self.names
        return np.array([self.weight[[names[f] for f in word if f in names]].sum(0) for word in chain])

    def decode(self, chains: list[list[list[str]]]) -> list[list[int]]:
        """Best labels of each chain, by Viterbi over all chains of one length at once."""
        out: list[list[int]] = [[] for _ in chains]
        by_length: dict[int, list[int]] = {}
        for i, chain in enumerate(chains):
            by_length.setdefault(len(chain), []).append(i)
        for length, rows in by_length.items():
            for at in range(0, len(rows), 256):
                part = rows[at : at + 256]
                scores = np.array([self.emissions(chains[i]) for i in part])
                best = self.step[OUTSIDE][None] + scores[:, 0]
                back = []
                for t in range(1, length):
                    reached = best[:, :, None] + self.step[None]
                    back.append(reached.argmax(1))
                    best = reached.max(1) + scores[:, t]
                label = (best + self.step[:, OUTSIDE][None]).argmax(1)
                path = [label]
                for b in reversed(back):
                    label = b[np.arange(len(part)), label]
                    path.append(label)
                for i, labels in zip(part, np.array(path[::-1]).T.tolist(), strict=True):
                    out[i] = labels
        return out


def train(texts: list[list[tuple[str, str]]], epochs: int = 30, rate: float = 0.1, penalty: float = 1e-3) -> Field:
    """A field fitted to labelled texts by the gradient of the log likelihood (Adam, whole table a step by chain length)."""
    chains = _chains(texts)
    names = {f: i for i, f in enumerate(sorted({f for chain, _ in chains for word in chain for f in word}))}
    n = len(LABELS)
    weight, step = np.zeros((len(names), n)), np.zeros((n, n))
    forbidden = np.zeros((n, n))
    for a, x in enumerate(LABELS):
        for b, y in enumerate(LABELS):
            if y.startswith("I-") and x not in (f"B-{y[2:]}", y):
                forbidden[a, b] = -1e4  # an inside follows its own kind only
    groups: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for chain, labels in chains:
        ids = np.array([[names[f] for f in word] for word in chain])
        groups.setdefault(len(chain), []).append((ids, np.array(labels)))
    batches = [(np.array([x for x, _ in g]), np.array([y for _, y in g])) for g in groups.values()]
    state = [np.zeros_like(weight), np.zeros_like(weight), np.zeros_like(step), np.zeros_like(step)]
    for turn in range(1, epochs + 1):
        slope, step_slope = penalty * weight, penalty * step
        for ids, gold in batches:
            rows, length, _ = ids.shape
            score = weight[ids].sum(2)
            move = step + forbidden
            ahead = [move[OUTSIDE][None] + score[:, 0]]
            for t in range(1, length):
                ahead.append(_logsum(ahead[-1][:, :, None] + move[None], 1) + score[:, t])
            behind = [np.repeat(move[:, OUTSIDE][None], rows, 0)]
            for t in range(length - 1, 0, -1):
                behind.insert(0, _logsum(move[None] + (score[:, t] + behind[0])[:, None, :], 2))
            total = _logsum(ahead[-1] + move[:, OUTSIDE][None], 1)
            at = np.arange(rows)
            for t in range(length):
                chance = np.exp(ahead[t] + behind[t] - total[:, None])
                chance[at, gold[:, t]] -= 1
                np.add.at(slope, ids[:, t], (chance / len(chains))[:, None, :])
                if t:
                    pair = np.exp(ahead[t - 1][:, :, None] + move[None] + (score[:, t] + behind[t])[:, None, :] - total[:, None, None])
                    np.add.at(pair, (at, gold[:, t - 1], gold[:, t]), -1)
                    step_slope = step_slope + pair.sum(0) / len(chains)
            first = np.exp(ahead[0] + behind[0] - total[:, None])
            first[at, gold[:, 0]] -= 1
            last = np.exp(ahead[-1] + behind[-1] - total[:, None])
            last[at, gold[:, -1]] -= 1
            step_slope[OUTSIDE] += first.sum(0) / len(chains)
            step_slope[:, OUTSIDE] += last.sum(0) / len(chains)
        for k, (p, g) in enumerate(((weight, slope), (step, step_slope))):
            state[2 * k] = 0.9 * state[2 * k] + 0.1 * g
            state[2 * k + 1] = 0.99 * state[2 * k + 1] + 0.01 * g * g
            p -= rate * (state[2 * k] / (1 - 0.9**turn)) / (np.sqrt(state[2 * k + 1] / (1 - 0.99**turn)) + 1e-8)
    return Field(names, weight, step + forbidden)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def chains_of(text: str) -> Iterator[list[tuple[int, int, str, str]]]:
    """Runs of neighbouring words that hold a digit or an at sign: (start, end, word before, word after) of each word."""
    chain: list[tuple[int, int, str, str]] = []
    last_end, hit = 0, _HINT.search(text)
    while hit:
        start = hit.start()
        while start > last_end and text[start - 1] not in _WHITE:
            start -= 1
        stop = _END.search(text, hit.end())
        end = stop.start() if stop else len(text)
        touching = bool(chain) and not text[last_end:start].strip(_WHITE)
        if chain and not touching:
            yield _with_neighbours(text, chain)
            chain = []
        chain.append((start, end, "", ""))
        last_end = end
        hit = _HINT.search(text, end)
    if chain:
        yield _with_neighbours(text, chain)


def _word_before(text: str, at: int) -> str:
    while at and text[at - 1] in _WHITE:
        at -= 1
    start = at
    while start and text[start - 1] not in _WHITE:
        start -= 1
    return text[start:at]


_NEXT = re.compile(r"[^\x20\x09-\x0D]+")


def _word_after(text: str, at: int) -> str:
    found = _NEXT.search(text, at)
    return found.group() if found else ""


def _with_neighbours(text: str, chain: list[tuple[int, int, str, str]]) -> list[tuple[int, int, str, str]]:
    words = [_word_before(text, chain[0][0]), *(text[a:b] for a, b, _, _ in chain), _word_after(text, chain[-1][1])]
    return [(a, b, words[i], words[i + 2]) for i, (a, b, _, _) in enumerate(chain)]


def field_spans(texts: list[str], field: Field) -> list[list[Span]]:
    """Spans that the field finds in each text, trimmed of marks around them."""
    chains, owners = [], []
    for i, text in enumerate(texts):
        if _HINT.search(text):
            for chain in chains_of(text):
                chains.append(chain)
                owners.append(i)
    labels = field.decode([[features(texts[i][a:b], x, y) for a, b, x, y in chain] for i, chain in zip(owners, chains, strict=True)])
    out: list[list[Span]] = [[] for _ in texts]
    for i, chain, tags in zip(owners, chains, labels, strict=True):
        k = 0
        while k < len(tags):
            stop = k + 1
            if tags[k] != OUTSIDE:
                kind = LABELS[tags[k]][2:]
                while stop < len(tags) and LABELS[tags[stop]] == f"I-{kind}":
                    stop += 1
                start, end = chain[k][0], chain[stop - 1][1]
                found = texts[i][start:end]
                core = found.strip(_EDGE + "." if kind != "phone" else "\"'[]{}<>,;:!?*#$%&|.")
                start += found.find(core) if core else 0
                if core:
                    out[i].append((kind, start, start + len(core)))
            k = stop
    return out


def all_spans(texts: list[str], field: Field | None) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text; a span of the field that meets a base span adds nothing."""
    out = []
    more = field_spans(texts, field) if field else [[] for _ in texts]
    for text, added in zip(texts, more, strict=True):
        base = base_spans(text)
        new = [s for s in added if all(s[2] <= b[1] or b[2] <= s[1] for b in base)]
        order = sorted(base + new, key=lambda s: (FIELD_KINDS.index(s[0]), s[1], s[2]))
        out.append((sorted(base, key=lambda s: (KINDS.index(s[0]), s[1])), order))
    return out


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _find(field: Field | None):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = all_spans(batch.column(1).to_pylist(), field)
            counts = [pa.array([sum(s[0] == kind for s in base) for base, _ in found], pa.int64()) for kind in KINDS]
            digest = pa.array([hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in found], pa.string())
            spans = pa.array([_joined(every) for _, every in found], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, digest, spans], names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return of


def find_personal_data(docs: DataFrame, field: Field | None, text: str = "text", id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, the number of base spans of each kind, base_sha256, and all spans.

    Spans are written kind:start:end, by kind (those of the patterns first, then ``secret``) and start.
    Null text is empty and has no spans. Offsets are code points, ends exclusive. Rows repeated with one id are searched
    one by one. An empty table gives no rows; other columns are ignored.
    """
    source = docs.select(F.col(id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    columns = ", ".join(f"n_{k} long" for k in KINDS)
    return source.mapInArrow(_find(field), f"doc_id {kind}, {columns}, base_sha256 string, spans string")
