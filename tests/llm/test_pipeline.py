"""The pipeline's whole run against a plain version of each stage, on a small table of documents."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

from tokenizers import Tokenizer

import corpus_pipeline
from listenlake.llm import common, language_id
from listenlake.llm.queries import tokenizer_file
from test_llm_operators import DOCS

WORDS = {"en": "the house river green walk with under stone", "de": "das haus fluss grün gehen mit unter stein"}


def made_documents() -> list[tuple]:
    rng = random.Random(3)
    rows: list[tuple] = []
    for i in range(120):
        lang = "en" if i % 2 else "de"
        text = " ".join(rng.choice(WORDS[lang].split()) + rng.choice(["", "s", "er"]) for _ in range(rng.randint(5, 90)))
        rows.append((i, text, lang, f"s{i % 3}", None))
    rows += [(200 + i, rows[i][1].replace(" ", "\n", 2), "en", "s1", None) for i in range(10)]  # equal but for white space
    rows += [(300 + i, f"{rows[i][1]} again", "en", "s2", None) for i in range(10)]  # near copies of the longer ones
    greek = " ".join("το σπίτι είναι δίπλα στο ποτάμι και το δάσος".split() * 4)
    rows += [(403, greek, None, "s1", None), (404, "дом стоит у реки и леса " * 5, None, "s1", None)]
    return [*rows, (400, None, None, None, None), (401, "12 34 --", "en", "s0", 8), (402, "", "de", None, 0)]


def shingles(text: str) -> set[tuple[str, ...]]:
    words = re.findall(rf"[^{common.SPACE}]+", text.lower())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def after_copies(rows: list) -> dict[int, str]:
    """Smallest id of each text that is equal but for white space, then of each group of near duplicates."""
    first: dict[str, int] = {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        first.setdefault(re.sub(rf"[{common.SPACE}]+", " ", r.text or ""), r.doc_id)
    kept = sorted(first.values())
    text = {r.doc_id: r.text or "" for r in rows}
    sets = {i: shingles(text[i]) for i in kept}
    group = {i: i for i in kept}
    changed = True
    while changed:
        changed = False
        for a in kept:
            for b in kept:
                if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) > 0 and group[a] != group[b]:
                    group[a] = group[b] = min(group[a], group[b])
                    changed = True
    return {i: text[i] for i in kept if group[i] == i}


def test_pipeline_run_equals_plain_stages(spark, tmp_path):
    docs = spark.createDataFrame(made_documents(), DOCS)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    model_file = tokenizer_file("piece_bpe_32k.model")
    read = common.table(spark, str(tmp_path), "documents")
    found = language_id.with_language(read, language_id.learned_model(read, model_file)).collect()
    sure = [r for r in found if r.lang_pred != "und" and r.lang_fit >= corpus_pipeline.LEAST_FIT]
    assert {r.doc_id for r in found} - {r.doc_id for r in sure} == {400, 401, 402, 403, 404}
    left = after_copies(sure)
    assert set(left) < {r.doc_id for r in sure} and not any(200 <= i < 210 for i in left)

    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    tokenizer = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    copies = Counter(r.doc_id for r in rows if r.piece == 0)
    assert set(copies) <= set(left) and max(copies.values()) <= 3
    words = {i: len(text.split()) for i, text in left.items()}
    taken = sum(words[i] * n for i, n in copies.items())
    # Each of three sources misses its target by half a document at most.
    assert abs(taken - sum(words.values())) <= 1.5 * max(words.values())
    sequences = defaultdict(list)
    for r in rows:
        assert (r.piece, r.start, r.length) == (0, 0, len(tokenizer.encode(left[r.doc_id], add_special_tokens=False).ids) + 1)
        sequences[r.sequence_id].append(r)
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert len(sequences) == -(-sum(r.length for r in rows) // 2048)
