"""Every corpus query over the awkward fixture and over empty tables, against plain Python."""

from __future__ import annotations

import base64
import hashlib
import math
from collections import Counter, defaultdict

import pytest

from ratescope.llm.queries import QUERIES
from tests.llm import brute, fixture

DOCS = [(r[0], r[1]) for r in fixture.documents()]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    return fixture.write(spark, str(tmp_path_factory.mktemp("awkward")))


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return fixture.write_empty(spark, str(tmp_path_factory.mktemp("empty")))


def rows(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_no_rows(spark, empty, name):
    assert QUERIES[name](spark, empty).count() == 0


def test_substring_dedup(spark, folder):
    got = rows(QUERIES["op1_substring_dedup"](spark, folder), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == Counter(brute.substring_dedup(DOCS))
    assert sum(r[2] for r in got) > 5_000


def test_decontamination(spark, folder):
    got = rows(QUERIES["op2_decontamination"](spark, folder), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == Counter(brute.decontamination(DOCS, [r[:2] for r in fixture.BENCHMARK]))
    assert any(r[5] for r in got)


def test_decontamination_in_several_automata(spark, folder):
    from ratescope.llm import decontaminate
    from ratescope.llm.common import documents, read_table

    docs, items = documents(spark, folder), read_table(spark, folder, "benchmark")
    one = decontaminate.with_hits(docs, items).select("doc_id", "_dc")
    many = decontaminate.with_hits(docs, items, shard_words=5).select("doc_id", "_dc")
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))


def test_decontaminated_text(spark, folder):
    from ratescope.llm import decontaminate
    from ratescope.llm.common import read_table

    docs = read_table(spark, folder, "documents")
    clean = decontaminate.decontaminate(docs, read_table(spark, folder, "benchmark"))
    assert clean.columns == docs.columns
    text = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert 94 not in text and "harbours" not in text[98] and text[90] is None and text[0] == DOCS[0][1]


def test_quality_rules(spark, folder):
    found = QUERIES["op3_quality_rules"](spark, folder)
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert rows(found, *columns) == Counter(brute.quality_base(DOCS))
    verdict = {r["doc_id"]: r for r in found.collect()}
    assert not any(r["kept"] and r["base_failed"] for r in verdict.values())
    assert verdict[7]["kept"] and verdict[95]["kept"] and not verdict[99]["kept"]


def test_quality_filter_agrees_with_the_verdicts(spark, folder):
    from ratescope.llm import quality_rules
    from ratescope.llm.common import read_table

    docs = read_table(spark, folder, "documents")
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    judged = QUERIES["op3_quality_rules"](spark, folder).where("kept")
    assert rows(kept, "doc_id") == rows(judged, "doc_id")


def test_quality_labels_of_the_synthetic_corpus(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    judged = {r["doc_id"]: r for r in QUERIES["op3_quality_rules"](spark, sf).collect()}
    wrong = [i for i, q in labels.items() if not judged[i]["base_failed"] and judged[i]["kept"] != bool(q)]
    assert len(wrong) <= 0.02 * len(labels)


def test_warc(spark, folder):
    expected, first = [], {}
    for page, _, html in fixture.PAGES:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    for page, _, html in fixture.PAGES:
        raw = (html or "").encode()
        least = first.get(html or "")
        again = least is not None and page != least
        expected.append((page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", least if again else None))
    found = QUERIES["op4_warc"](spark, folder)
    assert rows(found, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == Counter(expected)


def test_warc_files_are_the_same_in_every_run(spark, folder, tmp_path):
    from ratescope.llm import warc
    from ratescope.llm.common import read_table

    pages = read_table(spark, folder, "pages")
    runs = [warc.write_archives(p, str(tmp_path / n), shard_bytes=900, roll_bytes=300) for n, p in (("a", pages), ("b", pages.repartition(5)))]
    manifests = [rows(m, "file", "n_records", "n_bytes", "sha256") for m in runs]
    assert manifests[0] == manifests[1] and len(manifests[0]) > 3
    payloads = rows(warc.read_archives(spark, str(tmp_path / "a")).where("record_type = 'response'"), "payload")
    assert {bytes(k[0]).decode() for k in payloads} == {r[2] or "" for r in fixture.PAGES}


def test_warc_damage_is_noticed():
    from ratescope.llm import warc

    whole = warc.build_record(1, "http://x/a b\r\nc", b"payload", 7, warc.digest(b"payload"), None)
    assert [(f["Page-ID"], p) for f, p in warc.parse_records(whole + whole)] == [("1", b"payload")] * 2
    other = warc.build_record(1, "u", b"changed", 7, warc.digest(b"payload"), None)
    with pytest.raises(ValueError):
        list(warc.parse_records(other))


def test_html_extraction(spark, folder):
    found = QUERIES["op5_html_extraction"](spark, folder)
    text = defaultdict(set)
    for r in found.collect():
        assert r["n_chars"] == len(r["text"])
        text[r["page_id"]].add(r["text"])
    article = "Title & more\nFirst block goes on.\nSecond <block>"
    assert text[1] == {article} and text[4] == {article} and text[2] == {""} and text[3] == {""}
    assert text[5] == {"Short."} and text[None] == {"no markup at all"}
    assert text[6] == {("A long article text. " * 30).strip(), "unclosed bold end"}


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    found = {r["doc_id"]: r for r in QUERIES["op6_toxicity"](spark, sf).collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    for i, r in found.items():
        assert r["held_out"] == (brute.crc(i) % 3 == 1) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    toxic = [found[i]["score"] for i, y in labels.items() if y and found[i]["held_out"]]
    clean = [found[i]["score"] for i, y in labels.items() if not y and found[i]["held_out"]]
    above = sum((t > c) + 0.5 * (t == c) for t in toxic for c in clean) / len(toxic) / len(clean)
    assert above > 0.93
    assert sum(c >= 0.7 for c in clean) <= 0.01 * len(clean) and sum(t >= 0.7 for t in toxic) >= 0.5 * len(toxic)


def test_toxicity_over_awkward_rows(spark, folder):
    found = QUERIES["op6_toxicity"](spark, folder).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(i for i, _ in DOCS)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_pattern_voters_read_whole_texts():
    from ratescope.llm.toxicity import letters_of, patterns

    quiet, loud = "small words go on and on here " * 100, "SHOUTING AT EVERYONE HERE " * 2_000
    assert patterns(quiet + loud)[0] and not patterns("HEADLINE " * 250 + quiet * 20)[0]
    assert not patterns("Ü" * 10 + "ü" * 10)[0] and patterns("ÜÄ ÖÉ !")[0]
    for text in ("aB Cé ÉÀ1 漢字 ß", "", "ABC"):
        assert letters_of(text) == (sum(map(str.isupper, text)), sum(map(str.isalpha, text)))


def test_label_model_equals_one_fitted_in_memory(spark, folder):
    """Expectation-maximisation over counted votes against the same over rows, and all documents not held out are in it."""
    import numpy as np

    from ratescope.llm import toxicity
    from ratescope.llm.common import documents, read_table

    docs = documents(spark, folder)
    ids = toxicity.labelled_ids(read_table(spark, folder, "labels"), 1_000)
    slots, _, label = toxicity.sample(docs, ids)
    entries = np.unique(np.concatenate(slots))[::40][:30]
    counts = toxicity.vote_counts(docs, ids, entries)
    voters = len(entries) + toxicity.N_PATTERNS
    rows = counts.toPandas()
    assert rows["n"].sum() == sum(i is not None and brute.crc(i) % 3 != 1 for i, _ in DOCS) and len(rows) > 20
    model = toxicity.fit_label_model(counts, voters)
    x = np.repeat(toxicity._unpacked(rows, voters), rows["n"], axis=0)
    y = np.repeat(rows["label"].to_numpy(), rows["n"])
    soft = np.where(y >= 0, y, y[y >= 0].mean()).astype(float)
    for _ in range(15):
        weight = np.array([len(x) - soft.sum(), soft.sum()])
        rates = np.clip(np.array([(1 - soft) @ x + 0.1, soft @ x + 0.2]) / (weight + 2)[:, None], 1e-4, 0.999)
        rest = x - (soft[:, None] * rates[1] + (1 - soft)[:, None] * rates[0])
        spread = rest.std(axis=0) + 1e-9
        together = (rest.T @ rest) / len(x) / np.outer(spread, spread)
        together = np.where(together > toxicity.LEAST_CORRELATION, np.minimum(together, 1), 0)
        plain = toxicity.LabelModel(float(np.clip(soft.mean(), 0.01, 0.9)), rates, 1 / np.clip(together.sum(axis=1), 1, None))
        soft = plain.posterior(x, y)
    assert np.allclose(model.rates, plain.rates) and np.allclose(model.voice, plain.voice, atol=1e-4) and np.isclose(model.prior, plain.prior)


def test_mixing(spark, folder):
    first = rows(QUERIES["op7_mixing"](spark, folder), "doc_id", "size", "source_size", "target", "taken")
    assert first == rows(QUERIES["op7_mixing"](spark, folder), "doc_id", "size", "source_size", "target", "taken")
    table = fixture.documents()
    size = [len(brute.WORD.findall(r[1] or "")) for r in table]
    totals: Counter = Counter()
    for r, n in zip(table, size):
        totals[r[3]] += n
    order = sorted((s for s in totals if s is not None)) + [s for s in totals if s is None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    target, left, open_ = {}, 1.5 * sum(totals.values()), list(order)
    while open_:
        rate = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if rate * weight[s] >= 2 * totals[s]]
        if not full:
            target |= {s: rate * weight[s] for s in open_}
            break
        for s in full:
            target[s] = 2.0 * totals[s]
            left -= target[s]
            open_.remove(s)
    source = {(r[0], n): r[3] for r, n in zip(table, size)}
    taken: Counter = Counter()
    for (doc, n, source_size, wanted, took), times in first.items():
        s = source[doc, n]
        assert source_size == totals[s] and math.isclose(wanted, target[s]) and 0 <= took <= 2 * n and took % max(n, 1) == 0
        taken[s] += took * times
    assert sum(first.values()) == len(table)
    for s in order:
        largest = max(n for r, n in zip(table, size) if r[3] == s)
        assert abs(taken[s] - target[s]) <= 2 * largest


def test_near_dedup(spark, folder):
    found = QUERIES["op8_near_dedup"](spark, folder).collect()
    component, sizes = brute.near_components(DOCS)
    assert len(found) == len(DOCS)
    for r in found:
        assert r["component_id"] == component[r["doc_id"]] and r["n_shingles"] in sizes[r["doc_id"]]
        assert r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"])
    assert len({i for i, c in component.items() if i != c}) > 20


def test_components_of_chains_and_stars(spark):
    from ratescope.llm.components import components

    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (300, 200), (250, 300)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {k: 100 for k in range(101, 160)} | {300: 200, 250: 200}


def test_language_model(spark, folder):
    found = QUERIES["op9_language_model"](spark, folder).collect()
    counts: Counter = Counter()
    for i, t in DOCS:
        if i is not None and brute.crc(i) % 7 != 2:
            counts.update([*(t or "").translate(brute.SMALL).encode().split(), None])
    n, kinds = sum(counts.values()), len(counts)
    texts = defaultdict(list)
    for i, t in DOCS:
        tokens = [*(t or "").translate(brute.SMALL).encode().split(), None]
        texts[i].append((len(tokens), sum(counts[w] > 0 for w in tokens), round(sum(math.log10((counts[w] + 1) / (n + kinds + 1)) for w in tokens), 5)))
    assert Counter(r["doc_id"] for r in found) == Counter(i for i, _ in DOCS)
    for r in found:
        assert (r["n_tokens"], r["n_known"], round(r["base_score"], 5)) in texts[r["doc_id"]]
        assert r["train_tokens"] == n and r["held_out"] == (r["doc_id"] is not None and brute.crc(r["doc_id"]) % 7 == 2)
        assert -10 * r["n_tokens"] < r["score"] < 0


def test_language_model_beats_the_counts_on_held_out_documents(spark):
    found = QUERIES["op9_language_model"](spark, "/root/testdata/sf0.01").where("held_out").collect()
    assert sum(r["score"] for r in found) > sum(r["base_score"] for r in found) + 0.03 * sum(r["n_tokens"] for r in found)


def test_language_model_learns_from_every_training_token(spark, folder):
    from ratescope.llm import language_model
    from ratescope.llm.common import documents

    docs = documents(spark, folder)
    training = docs.where(docs.doc_id.isNotNull() & ~language_model.held_out(docs.doc_id))
    known = language_model.vocabulary(language_model.word_counts(training), training.count())
    assert language_model.train(language_model.numbered(training, known), known).seen == known.tokens > 0


def test_language_model_is_a_distribution():
    import numpy as np

    from ratescope.llm.language_model import SHAPES, Network

    network = Network(np.array([50.0, 30, 20, 9, 5, 4, 1]), np.ones(SHAPES), 9, hidden=5)
    states = np.random.default_rng(1).normal(size=(1, 5)).astype(np.float32)
    every = np.arange(7 + SHAPES + 1)
    likely = network.log_likelihood(np.repeat(states, len(every), axis=0), every)
    assert abs(np.exp(likely).sum() - 1) < 1e-4


def test_language_model_gradients():
    import numpy as np

    from ratescope.llm.language_model import SHAPES, Network

    network = Network(np.array([50.0, 30, 20, 9, 5, 4, 1]), np.ones(SHAPES), 9, hidden=5)
    for name in network.NAMES:
        setattr(network, name, getattr(network, name).astype(np.float64))
    rng = np.random.default_rng(2)
    states, tokens, used = rng.normal(size=(6, 5)), np.array([0, 3, 6, 9, 7 + SHAPES, 2]), np.array([1, 1, 1, 1, 1, 0], dtype=bool)
    grads, back = network.gradients(states, tokens, used)
    loss = lambda: -network.log_likelihood(states, tokens)[used].mean()
    for values, slope in ((states, back), (network.to_word, grads["to_word"]), (network.to_class, grads["to_class"])):
        at = np.unravel_index(np.argmax(np.abs(slope)), slope.shape)
        values[at] += 1e-5
        up = loss()
        values[at] -= 2e-5
        assert abs((up - loss()) / 2e-5 - slope[at]) < 1e-4
        values[at] += 1e-5


def _small_network(kind):
    import numpy as np

    from ratescope.llm.language_model import SHAPES, Network

    network = Network(np.array([50.0, 30, 20, 9, 5, 4, 1]), np.ones(SHAPES), 9, hidden=5)
    for name in network.NAMES:
        setattr(network, name, getattr(network, name).astype(kind))
    network.loop = network.loop * 4
    return network


def test_language_model_gradients_through_time():
    """Slopes of every parameter against differences of the loss over a window in which documents begin and lanes are idle."""
    import numpy as np

    from ratescope.llm.language_model import SHAPES

    network, rng = _small_network(np.float64), np.random.default_rng(3)
    steps, lanes = 6, 3
    h = rng.normal(size=(lanes, 5))
    inputs = rng.integers(0, 7 + SHAPES, size=(steps, lanes))
    inputs[0, 1] = inputs[3, 0] = inputs[3, 1]
    tokens = rng.integers(0, 7 + SHAPES + 1, size=(steps, lanes))
    used, fresh = np.ones((steps, lanes), bool), np.zeros((steps, lanes), bool)
    used[4:, 2] = False
    fresh[0, 0] = fresh[3, 1] = True

    def loss():
        at, states = h.copy(), []
        for t in range(steps):
            at = np.where(fresh[t][:, None], 0, at)
            at = network.step(at, network.inputs[inputs[t]] + network.bias)[0]
            states.append(at)
        return -network.log_likelihood(np.concatenate(states), tokens.ravel())[used.ravel()].mean()

    grads, rows, _ = network.window_gradients(h, inputs, tokens, used, fresh)
    assert rows.tolist() == sorted(set(inputs.ravel().tolist()))
    for name, slope in grads.items():
        values = getattr(network, name)
        for flat in np.argsort(-np.abs(slope).ravel())[:4].tolist():
            at = np.unravel_index(flat, slope.shape)
            place = (int(rows[at[0]]), at[1]) if name == "inputs" else at
            kept = values[place]
            values[place] = kept + 1e-5
            up = loss()
            values[place] = kept - 1e-5
            down = loss()
            values[place] = kept
            assert abs((up - down) / 2e-5 - slope[at]) < 1e-5 * max(1, abs(slope[at])), name


def test_language_model_scores_whole_documents_as_one_step_after_another_does():
    import numpy as np

    from ratescope.llm.language_model import SHAPES, score_documents

    network, rng = _small_network(np.float32), np.random.default_rng(4)
    lengths = np.array([1, 200, 3, 65, 1, 40, 64, 700])
    tokens = rng.integers(0, 7 + SHAPES + 1, size=lengths.sum())
    got = score_documents(network, tokens, lengths, window=16, lanes=3)
    for i, document in enumerate(np.split(tokens, np.cumsum(lengths)[:-1])):
        h, expected = np.zeros((1, 5), np.float32), 0.0
        for before, token in zip([7 + SHAPES, *document], document):
            h = network.step(h, network.inputs[[before]] + network.bias)[0]
            expected += float(network.log_likelihood(h, np.array([token]))[0])
        assert abs(got[i] - expected) < 1e-3 * max(1, abs(expected))


def test_language_model_with_large_weights_stays_finite():
    import numpy as np

    network = _small_network(np.float32)
    network.to_class *= 1000
    states = np.random.default_rng(1).normal(size=(50, 5)).astype(np.float32)
    tokens = np.arange(50) % 20
    assert np.isfinite(network.log_likelihood(states, tokens)).all()
    assert np.isfinite(network.gradients(states, tokens, np.ones(50, bool))[1]).all()


def test_language_model_twice_is_the_same(spark, folder):
    first, second = (sorted(map(str, QUERIES["op9_language_model"](spark, folder).collect())) for _ in range(2))
    assert first == second


def test_segments_hold_all_tokens():
    import numpy as np

    from ratescope.llm.language_model import in_segments

    assert in_segments(np.array([1, 4, 5, 12, 8]), 4).tolist() == [1, 4, 4, 1, 4, 4, 4, 4, 4]


def test_portions_hold_all_texts():
    import numpy as np

    from ratescope.llm import language_model as lm

    known = lm.Vocabulary({b"a": 0, b"bb": 1}, np.array([0, 1], np.int32), np.zeros(2), 2, 1, 1, 1, np.ones(lm.SHAPES), np.ones(lm.SHAPES), np.ones(2))
    texts = ["a bb zzz a", None, "", "q " * 50, "A"]
    for most in (1, 6, 1000):
        found = list(lm.portions(texts, known, {}, most))
        assert np.concatenate([p.lengths for p in found]).tolist() == [5, 1, 1, 51, 2]
        assert [w for p in found for w in p.unknown] == [[b"zzz"], [], [], [b"q"] * 50, []]
        tokens = np.concatenate([p.tokens for p in found]).tolist()
        assert tokens[:5] == [0, 1, 2 + lm.shape(b"zzz"), 0, 2 + lm.SHAPES] and tokens[-2:] == [0, 2 + lm.SHAPES]


def test_line_dedup(spark, folder):
    got = rows(QUERIES["op10_line_dedup"](spark, folder), "doc_id", "n_lines", "n_dropped", "kept_sha256")
    assert got == Counter(brute.line_dedup(DOCS))
    assert sum(r[2] for r in got) > 5


def test_cleaned_texts_match_their_digests(spark, folder):
    from ratescope.llm import line_dedup, substring_dedup
    from ratescope.llm.common import read_table

    docs = read_table(spark, folder, "documents")
    lines = line_dedup.dedup_lines(docs)
    assert lines.columns == [*docs.columns, "n_lines", "n_dropped"]
    digests = rows(QUERIES["op10_line_dedup"](spark, folder), "doc_id", "kept_sha256")
    assert Counter((r["doc_id"], brute.sha(r["text"] or "")) for r in lines.collect()) == digests
    passages = substring_dedup.remove_repeats(docs)
    digests = rows(QUERIES["op1_substring_dedup"](spark, folder), "doc_id", "kept_sha256")
    assert Counter((r["doc_id"], brute.sha(" ".join(brute.WORD.findall(r["text"] or "")))) for r in passages.collect()) == digests
