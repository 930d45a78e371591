"""A small set of tables with the awkward cases: nulls, empty and long texts, copies, ties, repeats, clashing columns."""

from __future__ import annotations

import random
import struct

VOICES = [f"{a}{b}{c}" for a in ("ba", "ko", "mi", "tu") for b in ("rel", "nos", "vik", "dam") for c in ("a", "en", "ot", "is")]


def prose(rng: random.Random, n: int, per_line: int = 12) -> str:
    words = [rng.choice(VOICES) + rng.choice(VOICES)[:2] for _ in range(n)]
    return "\n".join(" ".join(words[i:i + per_line]) for i in range(0, n, per_line))


def documents() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars, kept, size, copies)."""
    rng = random.Random(4)
    texts: dict[int, str | None] = {i: prose(rng, rng.randint(15, 220)) for i in range(60)}
    base = prose(rng, 260)
    words = base.split(" ")
    for i in range(60, 75):  # near copies of one text, one word changed in each
        changed = list(words)
        changed[7 * (i - 58)] = f"odd{i}"
        texts[i] = " ".join(changed)
    for i in range(75, 83):
        texts[i] = texts[3]  # exact copies
    shared = prose(rng, 70, 70)
    for i in range(83, 90):  # a passage of 70 words and a long line that several documents share
        texts[i] = prose(rng, 90) + "\n" + shared + "\n" + "  The Same Licence Line of more than forty characters  \n" + prose(rng, 40)
    texts[90], texts[91], texts[92], texts[93] = None, "", " \t\n ", "one two three"
    texts[94] = " ".join(["again"] * 400)
    texts[95] = prose(rng, 9000)  # very long
    texts[96] = texts[95] + " tail"
    texts[97] = "Ünï " * 30 + " 　 ÄÖ"
    texts[98] = prose(rng, 60) + "\nquestion one asks about the colour of seven old boats near harbours today\n" + prose(rng, 30)
    texts[99] = " ".join(w + "%%%" for w in prose(rng, 80).split())
    rows = []
    for i, t in texts.items():
        source = None if i % 17 == 0 else f"s{i % 4 if i % 3 else 0}"
        rows.append((i, t, None if i % 5 == 0 else "en", source, None if t is None else len(t), i % 2 == 0, "big", 7))
    rows.append(rows[3])  # a repeated row
    rows.append((None, texts[5], "en", "s1", 5, None, None, None))
    return rows


DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept boolean, size string, copies int"
BENCHMARK = [
    (1, "Question one asks about the colour of seven old boats near harbours today", "x"), (1, "Question one", "y"), (2, None, None),
    (3, "", None), (None, "again again again", "z"), (5, "never seen words of an item that no document holds at all here", None),
]
PAGES = [
    (1, "http://a.example/x", "<html><body><nav><a href=/>Menu here</a></nav><article><h1>Title &amp; more</h1><p>First  block<br>goes on.<p>Second &lt;block&gt;</article><footer>Foot</footer></body></html>"),
    (2, "http://a.example/y", None), (3, None, ""), (4, "http://a.example/x", "<html><body><nav><a href=/>Menu here</a></nav><article><h1>Title &amp; more</h1><p>First  block<br>goes on.<p>Second &lt;block&gt;</article><footer>Foot</footer></body></html>"),
    (5, "http://b.example/", "<div class='sidebar'>" + "side words " * 60 + "</div><div class='story x12'><p>Short.</p><div class='comments'><p>I say</p></div></div>"),
    (6, "http://b.example/2", "<div class='sidebar'>s</div><div class='story x13'><p>" + "A long article text. " * 30 + "</p><form>Sign</form></div>"),
    (6, "http://b.example/2", "<p>unclosed <b>bold <script>var a = '</p>';</script> end"), (None, "http://c.example", "no markup at all"),
    (7, "http://c.example", "<script>never closed <p>text"),
]
def embeddings() -> list[tuple]:
    """(vec_id, embedding, label, cluster, distance, anchor, score)."""
    rng = random.Random(9)

    def vector(n: int = 64) -> list[float]:
        return [rng.gauss(0, 0.125) for _ in range(n)]

    vectors: dict[int, list | None] = {i: vector() for i in range(400)}
    for i in range(100, 160):  # close ones, some of them anchors
        vectors[i] = [x + rng.gauss(0, 0.004) for x in vectors[100]]
    for i in range(160, 175):
        vectors[i] = vectors[50]  # ties
    vectors[175], vectors[176], vectors[177] = None, [], vector(63)
    vectors[178], vectors[179] = vector() + [0.1, 0.2], [*vector()[:63], None]
    vectors[180], vectors[181] = [*vector()[:63], float("nan")], [*vector()[:63], float("inf")]
    vectors[182], vectors[183] = [0.0] * 64, [3e4 * (-1) ** i for i in range(64)]
    vectors[184] = [1e38] * 64
    vectors = {i: v and [x if x is None else struct.unpack("f", struct.pack("f", x))[0] for x in v] for i, v in vectors.items()}
    rows = [(i, v, None if i % 61 == 0 else i % 3 if i % 2 else 0, i, "far", i % 2 == 0, 1.5) for i, v in vectors.items()]
    rows += [rows[7], rows[50], rows[100], rows[100]]  # repeated rows, anchors among them
    rows.append((None, vectors[51], 1, None, None, None, None))
    return rows


EMBEDDINGS = "vec_id bigint, embedding array<float>, label int, cluster int, distance string, anchor boolean, score double"
URLS = [
    "http://www.Example.com/en/a?x=1#y", "http://example.com/en/", "https://blog.example.com/en/b", "http://notexample.com/en/", "http://example.com/EN/",
    "http://a.net/es/1", "http://net/fr/", "http://a.net/", "http://internet/es/", "no scheme", "", None, "http://", "x://y://z.com/p", "http://u@h.com:80/en",
    "http://example.com.", "http://example.com?q=/en/", "HTTP://WWW.EXAMPLE.COM/en/\n/x", "http://a.org/" + "long/" * 5_000, "http://ÄÖ.com/ü#", "http://com", "a://com/",
]
LABELS = [(i, i % 2, 1 if i % 7 == 0 else 0) for i in range(0, 80)] + [(3, 1, 1), (None, 1, 1), (999, 0, 1), (9, None, None)]


def write(spark, folder: str) -> str:
    def save(name, rows, schema):
        spark.createDataFrame(rows, schema).repartition(3).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")

    save("documents", documents(), DOCUMENTS)
    save("benchmark", BENCHMARK, "item_id bigint, text string, words string")
    save("pages", PAGES, "page_id bigint, url string, html string")
    save("labels", LABELS, "doc_id bigint, quality int, toxic int")
    save("embeddings", embeddings(), EMBEDDINGS)
    return folder


def write_empty(spark, folder: str) -> str:
    for name, schema in (
        ("documents", DOCUMENTS), ("benchmark", "item_id bigint, text string, words string"),
        ("pages", "page_id bigint, url string, html string"), ("labels", "doc_id bigint, quality int, toxic int"),
        ("embeddings", EMBEDDINGS),
    ):
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return folder
