"""Fill-in-middle: brute force over code points, exact restoration, hard texts."""

import hashlib
import random
import re
from collections import Counter

from llm.conftest import HARD, docs_of
from pyspark.sql import functions as F

from weftline.llm import infill

UNIT = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")


def plain_infill(doc, text, seed=42, share=50, suffix_first=80):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= share:
        return doc, text, n, "plain", text, None, None
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < suffix_first:
        return doc, text, n, "spm", f"<S>{suf}<P>{pre}<M>{mid}", len(pre), len(mid)
    return doc, text, n, "psm", f"<P>{pre}<S>{suf}<M>{mid}", len(pre), len(mid)


def check(docs, **options):
    rows = infill.infill(docs, **options)
    back = rows.withColumn("back", infill.restore(F.col("output"), F.col("form"))).collect()
    want = Counter(plain_infill(r["doc_id"], r["text"], **options) for r in docs.select("doc_id", "text").collect())
    assert Counter(tuple(r)[:-1] for r in back) == want
    assert all(r["back"] == r["text"] for r in back)
    return want


def test_random_texts_equal_brute_force_and_restore(spark):
    rng = random.Random(5)
    bits = ["a", "Wort", "é", "😀", "\x00", "\x1c", " ", "$1", "\\", "<", "<P", "S>", "<M", " ", "  ", "\n", "\t\x0b", "\r\n", "\xa0"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(900)]
    texts += [t + m for t, m in zip(texts, ["<P>", "<S>", "<M>"] * 20)]
    found = check(docs_of(spark, texts))
    assert {form for _, _, _, form, *_ in found} == {"plain", "spm", "psm"}
    check(docs_of(spark, texts), seed=7, share=100, suffix_first=0)


def test_very_long_text_neither_recurses_nor_tracks_back(spark):
    check(docs_of(spark, ["w " * 300_000, " " * 300_000 + "x", "x" + " " * 300_000, "x" * 500_000]), share=100)


def test_hard_and_empty(spark, hard, empty):
    assert sum(check(hard).values()) == len(HARD)
    assert infill.infill(empty).count() == 0
    assert infill.digests(infill.infill(hard)).columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    nothing = {r["doc_id"]: r for r in infill.infill(hard).collect() if r["doc_id"] in (2, 3)}
    assert all((r["n"], r["form"], r["output"], r["prefix_chars"]) == (0, "plain", "", None) for r in nothing.values())


def test_no_exchange_and_no_python(spark, hard):
    plan = infill.digests(infill.infill(hard))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
