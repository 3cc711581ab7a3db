"""Secret scans by grammar inference.

For each credential format a probabilistic automaton is learnt from labelled examples: the
prefix tree of the examples is folded by merging states whose transition and end frequencies
agree within a Hoeffding bound.  Characters are put into classes first and the longest common
prefix of a format is kept literally.  Formats of several dotted parts have an automaton for each.
Candidates are long runs of key characters and what begins inside them behind a delimiter, as
in a URL.  Each is scored by its mean log-likelihood under the automata whose prefix it has; it is
a secret if the score reaches the lowest one among held-out examples and its length is theirs,
or not below theirs for parts whose examples differ in length.

Three base patterns are always reported; the automata add spans, none are removed.  Spans
are in code points, ends exclusive.

Learning takes at most ``MOST_EXAMPLES`` labelled credentials of each format on the driver;
the automata (some hundred numbers) go with the tasks.  Scanning is linear in a text, also where
prefixes follow one another without end, and independent by row, without a shuffle: hot sources, copies and long texts need no care.  Null text is empty and has no spans.
Repeated rows give repeated results; further columns are carried along.
"""

from __future__ import annotations

import base64
import json
import math
import random
import re
from bisect import bisect_left
from collections.abc import Iterable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import lean_rows

#: The most labelled credentials of a format that are learnt from.
MOST_EXAMPLES = 400
#: Confidence of the compatibility test.
ALPHA = 0.05

_LOW, _UP, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
_ALNUM = _LOW + _UP + _DIGITS
# Public credential formats as literals and (alphabet, least length, largest length).
FORMATS = {
    "github": ("ghp_", (_ALNUM, 36, 36)),
    "gitlab": ("glpat-", (_ALNUM + "_-", 20, 20)),
    "slack": ("xoxb-", (_DIGITS, 10, 13), "-", (_DIGITS, 10, 13), "-", (_ALNUM, 24, 24)),
    "stripe": ("sk_live_", (_ALNUM, 24, 99)),
    "google": ("AIza", (_ALNUM + "_-", 35, 35)),
    "npm": ("npm_", (_ALNUM, 36, 36)),
    "sendgrid": ("SG.", (_ALNUM + "_-", 22, 22), ".", (_ALNUM + "_-", 43, 43)),
    "jwt": (),  # encoded JSON, see _web_token
}
BASE_KINDS = ("assign", "access", "hex")

_ASSIGN = re.compile(
    r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CANDIDATE = re.compile(r"(?<![A-Za-z0-9_+/.-])[A-Za-z0-9_+/.-]{16,}")
_KEYWORDS = ("passw", "secret", "token", "api")


def _web_token(draw: random.Random) -> str:
    """A signed token: header and claims as encoded JSON, and a signature."""

    def encoded(items: dict) -> str:
        raw = json.dumps(items, separators=(",", ":")).encode()
        return base64.urlsafe_b64encode(raw).decode().rstrip("=")

    def word(least: int, most: int) -> str:
        return "".join(draw.choices(_ALNUM, k=draw.randint(least, most)))

    kind, size = draw.choice([("HS256", 43), ("HS512", 86), ("ES256", 86), ("RS256", 342)])
    header = {"alg": kind} | ({"typ": "JWT"} if draw.random() < 0.8 else {})
    header |= {"kid": word(8, 40)} if draw.random() < 0.4 else {}
    claims = {"sub": draw.choice([word(4, 30), str(draw.randint(1, 10**10))])}
    for name, value in (
        ("name", f"{word(3, 9)} {word(3, 12)}"),
        ("iss", f"https://{word(4, 15).lower()}.example.com/"),
        ("iat", draw.randint(10**9, 2 * 10**9)),
        ("exp", draw.randint(10**9, 2 * 10**9)),
        ("jti", word(8, 40)),
    ):
        if draw.random() < 0.5:
            claims[name] = value
    header, claims = (dict(draw.sample(sorted(x.items()), len(x))) for x in (header, claims))
    return f"{encoded(header)}.{encoded(claims)}.{''.join(draw.choices(_ALNUM + '_-', k=size))}"


def labelled_examples(seed: int = 7, each: int = MOST_EXAMPLES) -> dict[str, list[str]]:
    """Credentials of the public formats, drawn at random and labelled by their format."""
    draw = random.Random(seed)

    def drawn(parts: tuple) -> str:
        return "".join(
            p if isinstance(p, str) else "".join(draw.choices(p[0], k=draw.randint(*p[1:])))
            for p in parts
        )

    return {
        kind: [drawn(parts) if parts else _web_token(draw) for _ in range(each)]
        for kind, parts in FORMATS.items()
    }


#: Characters of a class; they share its likelihood.
_ALIKE = {"0": 10, "a": 6, "g": 20, "A": 6, "G": 20}


def symbol(char: str) -> str:
    """The class of a character: digit, two ranges of small and of capital letters, or itself."""
    if char in _DIGITS:
        return "0"
    if char in _LOW:
        return "a" if char <= "f" else "g"
    if char in _UP:
        return "A" if char <= "F" else "G"
    return char


@dataclass
class State:
    seen: int = 0
    ends: int = 0
    to: dict[str, int] = field(default_factory=dict)
    taken: dict[str, int] = field(default_factory=dict)


@dataclass
class Automaton:
    """A deterministic probabilistic automaton for what follows ``prefix``.

    ``rest`` has the automata of further parts, each behind a dot.
    """

    prefix: str
    states: list[State]
    shortest: int
    longest: float
    alphabet: frozenset[str]
    least: float = -math.inf
    rest: list[Automaton] = field(default_factory=list)

    def score(self, text: str) -> float:
        """Mean log-likelihood of a text by symbol; minus infinity if it is not accepted."""
        words = text.split(".") if self.rest else [text]
        if len(words) != 1 + len(self.rest):
            return -math.inf
        total, symbols = 0.0, 0
        for part, word in zip([self, *self.rest], words, strict=True):
            total += part._total(word)
            if total == -math.inf:
                return total
            symbols += len(word) - len(part.prefix) + 1
        return total / symbols

    def _total(self, word: str) -> float:
        if not word.startswith(self.prefix) or not self.shortest <= len(word) <= self.longest:
            return -math.inf
        total, at = 0.0, 0
        for char in word[len(self.prefix) :]:
            chance, at = self.step(at, char)
            total += chance
            if total == -math.inf:
                return total
        return total + self.end(at)

    def step(self, at: int, char: str) -> tuple[float, int]:
        """The log-likelihood of one character in a state, and the next state."""
        state, kind = self.states[at], symbol(char)
        if kind not in self.alphabet:
            return -math.inf, 0
        # What the examples do not show here counts half an example.
        chance = state.taken.get(kind, 0.5) / (state.seen + 0.5) / _ALIKE.get(kind, 1)
        return math.log(chance), state.to.get(kind, 0)

    def end(self, at: int) -> float:
        last = self.states[at]
        return math.log((last.ends or 0.5) / (last.seen + 0.5))


def _prefix_tree(words: Iterable[str]) -> list[State]:
    states = [State()]
    for word in words:
        at = 0
        states[0].seen += 1
        for char in word:
            kind = symbol(char)
            if kind not in states[at].to:
                states[at].to[kind] = len(states)
                states[at].taken[kind] = 0
                states.append(State())
            states[at].taken[kind] += 1
            at = states[at].to[kind]
            states[at].seen += 1
        states[at].ends += 1
    return states


def _differ(n1: int, f1: int, n2: int, f2: int, alpha: float) -> bool:
    bound = math.sqrt(0.5 * math.log(2 / alpha)) * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))
    return abs(f1 / n1 - f2 / n2) > bound


def _compatible(states: list[State], a: int, b: int, alpha: float) -> bool:
    waiting = [(a, b)]
    while waiting:
        p, q = (states[x] for x in waiting.pop())
        if _differ(p.seen, p.ends, q.seen, q.ends, alpha):
            return False
        for kind in p.to.keys() | q.to.keys():
            if _differ(p.seen, p.taken.get(kind, 0), q.seen, q.taken.get(kind, 0), alpha):
                return False
            if kind in p.to and kind in q.to:
                waiting.append((p.to[kind], q.to[kind]))
    return True


def _fold(states: list[State], a: int, b: int) -> None:
    """Adds the tree below ``b`` to state ``a``."""
    waiting = [(a, b)]
    while waiting:
        p, q = (states[x] for x in waiting.pop())
        p.seen += q.seen
        p.ends += q.ends
        for kind, target in q.to.items():
            if kind in p.to:
                p.taken[kind] += q.taken[kind]
                waiting.append((p.to[kind], target))
            else:
                p.to[kind], p.taken[kind] = target, q.taken[kind]


def _learn_part(examples: list[str], train: list[str], alpha: float) -> Automaton:
    prefix = examples[0]
    for word in examples:
        while not word.startswith(prefix):
            prefix = prefix[:-1]
    states = _prefix_tree(w[len(prefix) :] for w in train)
    kept, fringe = [0], [(0, kind) for kind in sorted(states[0].to)]
    while fringe:
        parent, kind = fringe.pop(0)
        node = states[parent].to[kind]
        if node in kept:
            continue
        partner = next((k for k in kept if _compatible(states, k, node, alpha)), None)
        if partner is None:
            kept.append(node)
            fringe += [(node, k) for k in sorted(states[node].to)]
        else:
            states[parent].to[kind] = partner
            _fold(states, partner, node)
            fringe += [(k, s) for k in kept for s in sorted(states[k].to) if states[k].to[s] not in kept]
    number = {old: new for new, old in enumerate(kept)}
    final = [
        State(s.seen, s.ends, {k: number[t] for k, t in s.to.items()}, s.taken)
        for s in (states[k] for k in kept)
    ]
    shortest, longest = min(map(len, examples)), max(map(len, examples))
    # Of a part of no fixed length the examples do not show the largest one.
    alphabet = frozenset(kind for state in final for kind in state.to)
    return Automaton(prefix, final, shortest, longest if longest == shortest else math.inf, alphabet)


def learn(examples: list[str], alpha: float = ALPHA) -> Automaton:
    """The automaton of one format; a quarter of the examples sets its acceptance level."""
    examples = sorted(set(examples))[:MOST_EXAMPLES]
    if not examples:
        raise ValueError("a format needs examples")
    held = examples[::4] if len(examples) > 4 else examples
    train = [w for i, w in enumerate(examples) if i % 4 or len(examples) <= 4]
    cut = 1 + examples[0].count(".")
    if any(w.count(".") != cut - 1 for w in examples):
        cut = 1
    parts = []
    for k in range(cut):
        of_all, of_train = (
            [w.split(".")[k] if cut > 1 else w for w in words] for words in (examples, train)
        )
        parts.append(_learn_part(of_all, of_train, alpha))
    automaton = parts[0]
    automaton.rest = parts[1:]
    scores = [x for x in map(automaton.score, held) if x > -math.inf]
    automaton.least = min(scores, default=-math.inf) - 0.25
    return automaton


def learn_all(examples: dict[str, list[str]]) -> dict[str, Automaton]:
    return {kind: learn(words) for kind, words in examples.items()}


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the three base patterns, each leftmost and without overlap."""
    spans = []
    lowered = text.lower()
    if any(word in lowered for word in _KEYWORDS):
        spans += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    spans += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], BASE_KINDS.index(s[0])))


class _Run:
    """A run of key characters whose parts are scored without reading a place for each begin.

    Two begins that are in one state at one place have the same future.  Log-likelihoods from there to
    the end of a part are kept at every ``STEP``-th place, so the time is linear in the run.
    """

    STEP = 64

    def __init__(self, text: str):
        self.text = text
        self.dots = [m.start() for m in re.finditer(r"\.", text)]
        self.breaks = [m.start() for m in re.finditer(r"[/+]", text)]  # no automaton goes on over these
        self.futures: dict[tuple, float] = {}
        self.trimmed: dict[int, int] = {}

    def words(self, at: int, parts: int) -> list[tuple[int, int]]:
        """Begin and end of the next ``parts`` dotted words; none if there are fewer."""
        k = bisect_left(self.breaks, at)
        stop = self.breaks[k] if k < len(self.breaks) else len(self.text)
        k, found = bisect_left(self.dots, at), []
        for i in range(k, k + parts):
            end = min(self.dots[i] if i < len(self.dots) else stop, stop)
            found.append((at, end))
            if end == stop:
                break
            at = end + 1
        return found if len(found) == parts else []

    def trim(self, stop: int) -> int:
        """The end of a word that ends at ``stop`` without marks behind it."""
        if stop not in self.trimmed:
            end = stop
            while end and self.text[end - 1] in "-_":
                end -= 1
            self.trimmed[stop] = end
        return self.trimmed[stop]

    def total(self, part: Automaton, start: int, stop: int) -> float:
        if not part.shortest <= stop - start <= part.longest:
            return -math.inf
        if not self.text.startswith(part.prefix, start, stop):
            return -math.inf
        total, state, passed = 0.0, 0, []
        for at in range(start + len(part.prefix), stop):
            if at % self.STEP == 0 and part.longest == math.inf:
                key = (id(part), state, at, stop)
                if key in self.futures:
                    total += self.futures[key]
                    break
                passed.append((key, total))
            chance, state = part.step(state, self.text[at])
            total += chance
            if total == -math.inf:
                break
        else:
            total += part.end(state)
        for key, before in passed:
            self.futures[key] = total - before
        return total

    def reach(self, automaton: Automaton, at: int) -> tuple[float, int]:
        """How far the score of what begins at ``at`` is above the least one, and where it ends."""
        parts = [automaton, *automaton.rest]
        words = self.words(at, len(parts))
        if not words:
            return -math.inf, at
        total, symbols = 0.0, 0
        for part, (start, stop) in zip(parts[:-1], words, strict=False):
            total += self.total(part, start, stop)
            if total == -math.inf:
                return total, at
            symbols += stop - start - len(part.prefix) + 1
        last, (start, stop) = parts[-1], words[-1]
        ends = [stop, self.trim(stop)]
        if start + last.longest < stop and self.text[start + int(last.longest)] in "-_":
            ends.append(start + int(last.longest))
        for end in dict.fromkeys(ends):
            score = total + self.total(last, start, end)
            if score > -math.inf:
                above = score / (symbols + end - start - len(last.prefix) + 1) - automaton.least
                if above >= 0:
                    return above, end
        return -math.inf, at


def added_spans(text: str, automata: dict[str, Automaton]) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the candidates that an automaton accepts, by its best score."""
    found = []
    prefixes = {a.prefix for a in automata.values()}
    if not any(p in text for p in prefixes):
        return found
    begins = re.compile(rf"(?<![A-Za-z0-9])(?:{'|'.join(map(re.escape, sorted(prefixes, reverse=True)))})")
    for m in _CANDIDATE.finditer(text):
        run, behind = None, 0
        for begin in begins.finditer(m[0]):
            at = begin.start()
            if at < behind:
                continue
            run = run or _Run(m[0])
            best, end, kind = max(
                (
                    (*run.reach(a, at), kind)
                    for kind, a in automata.items()
                    if m[0].startswith(a.prefix, at)
                ),
                default=(-1.0, 0, ""),
            )
            if best >= 0:
                behind = end
                found.append((kind, m.start() + at, m.start() + end))
    return found


def scan_text(text: str | None, automata: dict[str, Automaton]) -> tuple[list, list]:
    """Base spans and all spans of one text, in order."""
    text = text or ""
    base = base_spans(text)
    order = [*BASE_KINDS, *sorted(automata)]
    every = base + added_spans(text, automata)
    return base, sorted(every, key=lambda s: (s[1], order.index(s[0]), s[2]))


def written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def redact(text: str, spans: list[tuple[str, int, int]], mark: str = "[SECRET]") -> str:
    """``text`` with each run of overlapping spans replaced by one mark."""
    out, at = [], 0
    for _, start, end in sorted(spans, key=lambda s: (s[1], s[2])):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


RESULT = (
    "struct<n_assign: long, n_access: long, n_hex: long, base: string, spans: string, "
    "redacted: string>"
)


def scan_secrets(
    docs: DataFrame, automata: dict[str, Automaton], text: str = "text", redacted: bool = True
) -> DataFrame:
    """``docs`` with a struct ``secrets``: counts of base kinds, base and all spans, redacted text.

    ``redacted`` is null where nothing was found (or if it is not asked for).
    """

    @F.pandas_udf(RESULT)
    @lean_rows
    def scan(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for value in texts:
            base, every = scan_text(value, automata)
            kinds = [s[0] for s in base]
            rows.append(
                (
                    *(kinds.count(k) for k in BASE_KINDS),
                    written(base),
                    written(every),
                    redact(value, every) if every and redacted else None,
                )
            )
        names = ["n_assign", "n_access", "n_hex", "base", "spans", "redacted"]
        return pd.DataFrame(rows, columns=names)

    return docs.withColumn("secrets", scan(F.col(f"`{text}`")))


def digest(scanned: DataFrame) -> DataFrame:
    return scanned.select(
        "doc_id",
        "secrets.n_assign",
        "secrets.n_access",
        "secrets.n_hex",
        F.sha2(F.col("secrets.base").cast("binary"), 256).alias("base_sha256"),
        "secrets.spans",
    )
