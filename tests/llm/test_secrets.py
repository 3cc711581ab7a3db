from __future__ import annotations

import hashlib
import math
import random
import re
import time

import pytest
from helpers import documents
from pyspark.sql import functions as F

from earshot.llm import secrets


@pytest.fixture(scope="module")
def automata():
    return secrets.learn_all(secrets.labelled_examples())


def plain_base(text):
    """The three patterns as they are stated."""
    keys = "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key")
    assign = re.compile(rf"({keys})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
    text = text or ""
    found = [("assign", *m.span()) for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    order = ("assign", "access", "hex")
    return sorted(found, key=lambda s: (s[1], order.index(s[0])))


TOKEN = secrets.labelled_examples(seed=123, each=1)
TEXTS = [
    None,
    "",
    "clean prose about a password and a token, nothing else",
    'API_KEY = "abcdef" password:x PassWd: "12345" token==aaaaaaaa',
    "é" * 50 + "AKIA" + "A1" * 8 + " AKIAshort",
    "0123456789abcdef" * 3 + "g" + "a" * 23,
    "secret = " + "ab" * 20,
    f"see {TOKEN['github'][0]}. and {TOKEN['jwt'][0]}",
    "ſecret=abcdefgh toKen=abcdefgh",
    ("word " * 4000) + "token: " + "z" * 4000,
    "token='" * 3,
]


def test_base_spans_equal_the_stated_patterns(spark, automata):
    rows = secrets.scan_secrets(documents(spark, TEXTS), automata).orderBy("doc_id").select("secrets.*").collect()
    for text, row in zip(TEXTS, rows, strict=True):
        assert row["base"] == secrets.written(plain_base(text))
        assert set(filter(None, row["base"].split(","))) <= set(filter(None, row["spans"].split(",")))
    digest = secrets.digest(secrets.scan_secrets(documents(spark, TEXTS), automata)).orderBy("doc_id").collect()
    for text, row in zip(TEXTS, digest, strict=True):
        assert row["base_sha256"] == hashlib.sha256(secrets.written(plain_base(text)).encode()).hexdigest()
        kinds = [s[0] for s in plain_base(text)]
        assert [row["n_assign"], row["n_access"], row["n_hex"]] == [kinds.count(k) for k in secrets.BASE_KINDS]


def test_automata_accept_their_format_only(automata):
    fresh = secrets.labelled_examples(seed=99, each=60)
    for kind, words in fresh.items():
        accepted = [k for w in words for k, a in automata.items() if a.score(w) >= a.least]
        assert accepted.count(kind) >= 57 and set(accepted) == {kind}
    prose = "The ghp_ prefix and glpat-word are-no-credentials-at-all but AIza/and/paths/neither_are xoxb-1"
    assert secrets.added_spans(prose, automata) == []


def test_states_with_equal_behaviour_are_merged():
    learnt = secrets.learn(["ab" * n for n in range(1, 40)])
    assert len(learnt.states) < 10
    with pytest.raises(ValueError):
        secrets.learn([])


def test_redaction(spark, automata):
    text = f"a token = {'ab' * 20} b {TOKEN['github'][0]} c"
    rows = secrets.scan_secrets(documents(spark, [text, "clean", None]), automata).orderBy("doc_id").collect()
    assert rows[0]["secrets"]["redacted"] == "a [SECRET] b [SECRET] c"
    assert rows[1]["secrets"]["redacted"] is None and rows[2]["secrets"]["redacted"] is None


def test_empty_table_repeated_rows_and_extra_columns(spark, automata):
    docs = documents(spark, ["x"]).withColumn("spans", F.lit(1))
    got = secrets.scan_secrets(docs.union(docs), automata)
    assert got.count() == 2 and got.distinct().count() == 1 and "spans" in got.columns
    assert secrets.scan_secrets(documents(spark, []), automata).count() == 0


def test_runs_scored_at_once_equal_every_begin_scored_alone():
    """Likelihoods kept along a run change nothing: each part summed from its own begin."""
    automata = secrets.learn_all(secrets.labelled_examples())
    draw = random.Random(3)
    pieces = ["eyJ", "eyJhbGci", "-", "_", "ghp_", "xoxb-", "12345678901", "aZ09", ".", "sk_live_"]
    for _ in range(300):
        run = secrets._Run("".join(draw.choices(pieces, k=40)))
        for automaton in automata.values():
            for part in (automaton, *automaton.rest):
                for start in range(0, len(run.text), 3):
                    word = run.text[start:]
                    assert math.isclose(
                        run.total(part, start, len(run.text)), part._total(word), abs_tol=1e-9
                    )


@pytest.mark.parametrize("unit", ["ghp_", "eyJ-", "eyJ.", "SG.", "sk_live_", "glpat-"])
def test_prefixes_without_end_take_linear_time(unit):
    automata = secrets.learn_all(secrets.labelled_examples())
    started = time.monotonic()
    secrets.added_spans(unit * 100_000 + ".a.b", automata)
    assert time.monotonic() - started < 60
