"""License scan against plain Python."""

import random
import re

import pyarrow as pa
import pytest
from edges import EDGE_ROWS, edge_table, empty_table
from pyspark.sql import functions as F

from tidecast.llm.license_scan import PHRASES, TEMPLATES, LicenseScanner, Template, scan_licenses, words_of

SMALL = (
    Template("one", "alpha beta gamma delta epsilon", 80),
    Template("two", "alpha zeta eta", 100),
    Template("far", "theta iota kappa lambda mu nu xi omicron", 50),
)
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text, templates=TEMPLATES, phrases=PHRASES):
    text = (text or "").translate(LOWER)
    words = WORD.findall(text)
    places = set()
    for phrase, label in phrases.items():
        own = phrase.split(" ")
        places |= {(label, i) for i in range(len(words)) if words[i : i + len(own)] == own}
    half = max(len(words_of(t.text)) for t in templates)
    blocks, at = set(), 0
    for sentence in re.split(r"\n|[.!?](?=[\x20\x09-\x0D]|\Z)", text):
        own = WORD.findall(sentence)
        low = 0
        while own:
            window = own[low : low + 2 * half]
            for k, t in enumerate(templates):
                wanted = set(words_of(t.text))
                shared = len(wanted & set(window))
                if 100 * shared >= t.least * len(wanted):
                    blocks.add((t.label, k, at + low, at + low + len(window), shared / len(wanted)))
            if low + 2 * half >= len(own):
                break
            low += half
        at += len(own)
    return len(words), places, blocks


def found(row):
    return row.n_words, set(map(tuple, row.places)), set(map(tuple, row.blocks))


def test_words_are_those_of_the_pattern():
    for _, text in EDGE_ROWS:
        assert words_of(text or "") == WORD.findall((text or "").translate(LOWER))


@pytest.mark.parametrize("order", [{}, {i: i * 7 % 5 for i in range(20)}])
def test_filters_lose_no_block(order):
    rnd = random.Random(len(order))
    words = sorted({w for t in SMALL for w in words_of(t.text)}) + ["other", "Ömega", "mit", "license", "x1"]
    scanner = LicenseScanner(SMALL, PHRASES, order)
    texts = []
    for _ in range(800):
        size = rnd.choice([0, 3, 8, 20, 60])
        texts.append("".join(rnd.choice(words) + rnd.choice([" ", " ", " ", ", ", ". ", ".", "!\n", "\n"]) for _ in range(size)))
    n, places, blocks = scanner.scan(pa.array(texts))
    n_met = 0
    for i, text in enumerate(texts):
        want = brute(text, SMALL)
        got = (int(n[i]), {(p["label"], p["first_word"]) for p in places[i]}, {tuple(b.values()) for b in blocks[i]})
        assert got == want
        n_met += len(blocks[i])
    assert n_met > 80


NOTICES = [
    *(t.text for t in TEMPLATES),
    "Some text. This work is licensed under the GNU General Public License, version 3. More.",
    "Licensed under CC BY-NC 4.0.\nReleased under the MIT License.",
    "the mit\nlicense, the MIT license; Apache\tLicense apache license",
    "released under no license, and the mit of it",
    ("filler words " * 70) + TEMPLATES[9].text.replace(",", "") + (" more of it" * 90),
    "gnu general public", "license gnu",
]


def test_query_equals_brute_force(spark):
    rows = EDGE_ROWS + [(1000 + i, t) for i, t in enumerate(NOTICES)] + [(None, NOTICES[0]), (1000, "mit license")]
    table = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'own' places", "'own' word")
    got = sorted(((r.doc_id, *map(str, map(sorted, found(r)[1:])), r.n_words) for r in scan_licenses(table.repartition(4)).collect()), key=str)
    want = sorted(((i, str(sorted(p)), str(sorted(b)), n) for i, t in rows for n, p, b in [brute(t)]), key=str)
    assert got == want
    labels = {b[0] for i, t in rows for b in brute(t)[2]}
    assert labels == {t.label for t in TEMPLATES}


def test_empty_tables_and_no_templates(spark):
    assert scan_licenses(empty_table(spark)).count() == 0
    rows = scan_licenses(edge_table(spark), (), PHRASES).where(F.size("blocks") > 0)
    assert rows.count() == 0
