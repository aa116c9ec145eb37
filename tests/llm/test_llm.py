"""Operators of the llm subpackage on small tables, against brute force."""

import hashlib
import itertools
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from check_queries import compare, connect
from pyspark.sql import functions as F

from xylemflow.llm import exact_dedup, language_id, licenses, line_dedup, mixing, near_dedup, packing, private_data, substring_dedup, topk_search
from xylemflow.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row_nr int"
LONG = " ".join(f"w{i * i % 977}" for i in range(30_000))


def docs_of(spark, texts, folder, sources=None):
    """A Parquet table of texts with ids in steps of 3 and a column whose name clashes."""
    rows = [(3 * i, t, "en" if i % 2 else None, (sources or ["s"])[i % len(sources or ["s"])], 0, 1) for i, t in enumerate(texts)]
    path = str(folder / "docs.parquet")
    spark.createDataFrame(rows, SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


EDGES = [None, "", "   \n\t", "a", "same text here", "same text here", LONG, LONG + " end", "x" * 3000, "é ü 中文 🙂", "\n\n\n"]


@pytest.fixture(scope="module")
def edges(spark, tmp_path_factory):
    return docs_of(spark, EDGES, tmp_path_factory.mktemp("edges"), ["a", None, "b"])


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty") / "docs.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    result = compare(spark, connect(FOLDER), QUERIES[name], ORACLES[name], FOLDER)
    assert result.startswith("ok"), result


def test_empty_tables(spark, empty):
    import public_tokenizers

    assert exact_dedup.copy_groups(empty).count() == 0
    assert near_dedup.near_components(empty).count() == 0
    assert mixing.mix_documents(empty).count() == 0
    assert packing.pack_documents(empty, public_tokenizers.path("word_bpe_49k.json")).count() == 0
    assert substring_dedup.remove_repeats(empty).count() == 0
    assert line_dedup.remove_repeated_chunks(empty).count() == 0
    assert private_data.digests(private_data.find_private_data(empty)).count() == 0
    assert language_id.predict_languages(empty).count() == 0
    assert topk_search.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_exact_copies(edges):
    got = {r.doc_id: r for r in exact_dedup.copy_groups(edges).collect()}
    assert (got[0].keep_id, got[0].group_size, got[0].kept, got[3].kept) == (3, 2, False, True)
    assert (got[12].keep_id, got[15].kept) == (15, True)
    assert got[18].text_sha256 == hashlib.sha256(LONG.encode()).hexdigest()
    assert exact_dedup.drop_copies(edges).columns == edges.columns
    assert exact_dedup.drop_copies(edges).count() == len(EDGES) - 2


def test_fingerprints_compose():
    data = np.frombuffer(LONG.encode(), np.uint8)
    whole = exact_dedup.fingerprints(data, np.array([0, len(data)]))[0]
    slow = [sum((int(b) + 1) * pow(r, i, exact_dedup.PRIME) for i, b in enumerate(data.tolist())) % exact_dedup.PRIME for r in exact_dedup.BASES]
    assert whole == (slow[0] << 31) | slow[1]


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def brute_components(texts):
    sets = {3 * i: shingles(t) for i, t in enumerate(texts)}
    parent = {i: i for i in sets}

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for a, b in itertools.combinations(sets, 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {i: (len(sets[i]), root(i)) for i in sets}


@pytest.mark.parametrize("share", [101, 50])
def test_near_copies(spark, tmp_path, monkeypatch, share):
    """Chains of edited texts with and without groups: the block join alone is complete too."""
    monkeypatch.setattr(near_dedup, "GROUP_PERCENT", share)
    random = np.random.default_rng(1)
    texts = list(EDGES)
    for _ in range(6):
        words = [f"v{x}" for x in random.integers(0, 500, random.integers(20, 90))]
        for _ in range(6):
            texts.append(" ".join(words))
            words = list(words)
            words[random.integers(len(words))] = "edit"
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_components(docs_of(spark, texts, tmp_path)).collect()}
    assert got == brute_components(texts)


def test_large_group_of_near_copies(spark, tmp_path):
    """Copies of a text and copies of its copies, at, above and below the limit, with shorter ones."""
    random = np.random.default_rng(4)
    base = [f"b{i}" for i in range(60)]

    def edited(words, edits):
        words = list(words)
        for at in random.integers(0, len(words), edits):
            words[at] = f"e{random.integers(0, 40)}"
        return words

    made = [base]
    made += [edited(base, n) for n in random.integers(1, 6, 60)]
    made += [edited(made[int(random.integers(1, 60))], n) for n in random.integers(0, 3, 60)]
    made += [base[:n] for n in range(44, 60, 3)] + [base[6:], base[3:50] + ["tail"] * 3, ["head"] * 8 + base]
    texts = [" ".join(words) for words in made]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_components(docs_of(spark, texts, tmp_path)).collect()}
    assert got == brute_components(texts)


@pytest.mark.parametrize("jumps", [1, 4])
def test_chains_of_leaders(spark, tmp_path, monkeypatch, jumps):
    """Texts that drift step by step, with copies beside each step: leaders have leaders themselves."""
    monkeypatch.setattr(near_dedup, "JUMPS", jumps)
    rng = np.random.default_rng(29)
    words, texts = [f"w{i}" for i in range(80)], []
    for step in range(24):
        words[int(rng.integers(80))] = f"s{step}"
        for copy in range(3):
            own = list(words)
            for at in rng.integers(0, 80, int(rng.integers(0, 4))):
                own[at] = f"c{int(rng.integers(12))}"
            texts.append(" ".join(own))
    rng.shuffle(texts)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_components(docs_of(spark, texts, tmp_path)).collect()}
    assert got == brute_components(texts)


def test_one_row_of_near_copies_stays(spark):
    """Rows of one id, null ids and a column named like a helper."""
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text, 7), (1, text + " end", 7), (4, text, 7), (None, text, 7), (None, "alone " * 3, 7), (5, None, 7), (5, "", 7), (1, "other " * 9, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _near_row int")
    kept = [tuple(r) for r in near_dedup.drop_near_copies(docs).collect()]
    assert sorted(map(str, kept)) == sorted(map(str, [rows[0], rows[4], rows[5], rows[6], rows[7]]))


def test_long_words_that_agree_modulo_a_power_of_two(spark, tmp_path):
    """Two different words of 1024 letters whose polynomial hashes agree are still different."""
    bits = [bin(i).count("1") % 2 for i in range(1024)]
    one, other = "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)
    texts = [one, other, one.upper()]
    got = {r.doc_id: r.component_id for r in near_dedup.near_components(docs_of(spark, texts, tmp_path)).collect()}
    assert got == {0: 0, 3: 3, 6: 0}


def test_substrings_of_rows_that_share_an_id(spark):
    random = np.random.default_rng(8)
    noise = lambda n: "".join(random.choice(list("abcdefgh "), n))
    passage, other = noise(110), noise(200)
    rows = [(1, passage), (5, noise(70) + passage), (5, other), (9, other[20:140]), (None, passage), (5, other[:90] + "!")]
    got = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    removed = {(r.doc_id, r.n_bytes): r.n_removed for r in got}
    assert removed == {(1, 110): 0, (5, 180): 110, (5, 200): 0, (9, 120): 120, (None, 110): 0, (5, 91): 0}


def test_substrings(spark, tmp_path):
    random = np.random.default_rng(2)
    passage = "".join(random.choice(list("abcdé "), 120))
    texts = [*EDGES, passage, "x" + passage[:60] + "zz" + passage[30:], passage[:50], passage[:49], "q" * 49 + passage + passage]
    got = {r.doc_id: r for r in substring_dedup.remove_repeats(docs_of(spark, texts, tmp_path)).collect()}
    seen = {}
    for i, text in enumerate(texts):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - 49):
            if seen.setdefault(data[k : k + 50], i) < i:
                gone[k : k + 50] = True
        rest = bytes(np.frombuffer(data, np.uint8)[~gone])
        row = got[3 * i]
        assert (row.n_bytes, row.n_removed, row.kept_sha256) == (len(data), gone.sum(), hashlib.sha256(rest).hexdigest()), i
        assert row.n_spans == (np.diff(np.append(False, gone).astype(int)) == 1).sum()


def test_mixing(edges):
    rows = mixing.mix_documents(edges).collect()
    assert sum(r.target for r in {r.source: r for r in rows}.values()) == pytest.approx(1.5 * sum(r["size"] for r in rows))
    for source in ("a", "b", None):
        own = [r for r in rows if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 1
    assert all(r.taken <= 2 * r["size"] for r in rows)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix_documents(edges).collect()))
    mixed = mixing.mixed_texts(edges)
    assert mixed.columns == edges.columns
    words = mixed.select(mixing.word_count(F.col("text")).alias("n")).agg(F.sum("n")).first()[0]
    assert words == sum(r.taken for r in rows)


def test_the_schedule_decides_the_mix(spark, monkeypatch):
    """Slots interleave sources and order the mix; without the low-discrepancy points the targets fail."""
    rows = [(i, "w " * 50, "abc"[i % 3], 1, 2, "t") for i in range(300)] + [(7, "w " * 50, "a", 1, 2, "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _size int, _taken int, _slot string").coalesce(1)
    found = mixing.mix_documents(docs).collect()
    first = [r.source for r in sorted((r for r in found if r.slot is not None), key=lambda r: r.slot)]
    assert all(len(set(first[i : i + 12])) == 3 for i in range(0, 120, 12))
    assert mixing.mixed_texts(docs).columns == docs.columns
    by_id = {r.doc_id: r.slot for r in found if r.doc_id != 7}
    order = [by_id[r.doc_id] for r in mixing.mixed_texts(docs).collect() if r.doc_id != 7]
    assert order == sorted(order) and len(order) > 100

    monkeypatch.setattr(mixing, "GOLDEN", 0.0)
    off = mixing.mix_documents(docs).collect()
    assert any(sum(r.taken for r in off if r.source == s) < 0.5 * next(r.target for r in off if r.source == s) for s in "abc")


def test_repeated_ids_and_clashing_names(spark):
    """Rows of one id, null ids and columns named like helpers, in every stage that returns documents."""
    rows = [(1, "the same", "x", 3), (1, "the same", "y", 4), (1, "another text", "x", 5), (None, "the same", None, 6), (None, None, "x", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _row int").withColumns(
        {"_docs_row": F.lit(1), "_docs_row_nr": F.lit("orig"), "_spans": F.lit(2), "_near_row": F.lit(3), "lang": F.lit("en"), "n_chars": F.lit(4)}
    ).coalesce(1)
    kept = [(r.doc_id, r.text, r["_row"], r["_docs_row_nr"]) for r in exact_dedup.drop_copies(docs).collect()]
    assert sorted(map(str, kept)) == sorted(map(str, [(1, "the same", 4, "orig"), (1, "another text", 5, "orig"), (None, None, 7, "orig")]))
    clean = private_data.sanitised_texts(docs.withColumn("text", F.concat("text", F.lit(" a@b.example"))))
    assert clean.columns == docs.columns and clean.where("text LIKE '%[EMAIL]'").count() == 4
    model = language_id.fit(language_id.training_sample(docs))
    assert language_id.predict_languages(docs, model).count() == 5 and language_id.keep_known_languages(docs).columns == docs.columns
    assert mixing.mix_documents(docs).count() == 5
    assert line_dedup.remove_repeated_chunks(docs).count() == 5 and licenses.scan_licenses(docs).count() == 5


def test_packing(edges):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = packing.pack_documents(edges, path).collect()
    for i, text in enumerate(EDGES):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for r in sorted((r for r in rows if r.doc_id == 3 * i), key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for _, group in itertools.groupby(sorted(rows, key=lambda r: (r.sequence_id, r.offset)), lambda r: r.sequence_id):
        at = 0
        for r in group:
            assert r.offset == at
            at += r.length
        assert at <= packing.CAPACITY


def test_cutting_stock_uses_what_is_there():
    counts = np.random.default_rng(3).integers(1, 400, 33)
    demand = {s: int(counts[min(s, 64 - s)]) for s in range(1, 64)}  # each size can be paired up to 64
    patterns = packing.cutting_stock(demand, 64)
    for size, count in demand.items():
        assert sum(t * p.get(size, 0) for t, p in patterns) <= count
    assert all(sum(s * n for s, n in p.items()) <= 64 for _, p in patterns)
    filled = sum(t * sum(s * n for s, n in p.items()) for t, p in patterns)
    assert filled >= 0.99 * 64 * sum(t for t, _ in patterns)
    assert filled >= 0.9 * sum(s * n for s, n in demand.items())


def test_language_by_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.predict_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where(language_id.held_out(F.col("doc_id")))
    right, total = got.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count(F.lit(1))).first()
    assert right >= 0.97 * total


def test_unknown_language(edges):
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict_languages(edges).collect()}
    assert got[0] == got[3] == got[6] == got[30] == ("und", 0.0)
    assert got[12][0] == "en"


def test_all_letters_of_texts_without_blanks_count():
    random = np.random.default_rng(6)
    make = lambda letters, n: ["".join(random.choice(list(letters), 6)) for _ in range(n)]
    model = language_id.fit([(lang, make(abc, 32)) for lang, abc in (("a", "abcdef"), ("z", "uvwxyz")) for _ in range(40)])
    first, rest = make("abcdef", 10), make("uvwxyz", 200)
    for joint in ("", "\xa0", "\u3000", "_", "/"):
        shares = language_id.Labeller(model).document_scores([joint.join(first + rest), joint.join(first), "short " + joint.join(first + rest)])
        assert [model.languages[k] for k in shares.argmax(1)] == ["z", "a", "z"] and shares[0].max() > 0.85
    assert language_id.words_of("Don't\xa0stop/now_1 cafe\u0301") == ["don", "t", "stop", "now", "cafe"]
    assert "".join(language_id.words_of("\u4e2d" * 1000)) == "\u4e2d" * 1000


def test_private_data(spark, tmp_path):
    texts = [*EDGES, "é mail a.b@c.de_x@y.org, 1.2.3.4.5 and 300.1.1.1 🙂 4111 1111 1111 1111 +1 (555) 123-4567 +1 22"]
    texts += [f"call agent{i} zorblatt of {w} at secret@host.example now" for i, w in enumerate(("blue house", "red barn", "old mill"))]
    texts += [f"other mail user{i}@mail.example about nothing much" for i in range(6)]
    docs = docs_of(spark, texts, tmp_path)
    got = {r.doc_id: r for r in private_data.digests(private_data.find_private_data(docs)).collect()}
    row = got[3 * len(EDGES)]
    assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == (2, 1, 1, 1)
    assert got[0].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert "term" in got[3 * (len(EDGES) + 1)].spans and "term" not in got[3 * (len(EDGES) + 4)].spans
    clean = {r.doc_id: r.text for r in private_data.sanitised_texts(docs).collect()}
    assert clean[3 * (len(EDGES) + 1)].endswith("at [EMAIL] now") and "zorblatt" not in clean[3 * (len(EDGES) + 1)]
    assert clean[18] == LONG


def test_terms_are_counted_and_marked_over_whole_texts(spark, tmp_path):
    far = " ".join(f"filler{i}" for i in range(60))
    texts = [f"zorblatt{'x' * i} quixotic {i} {' '.join(far.split()[: 40 + i])} commonword unique{i} near secret@host.example" for i in range(4)]
    texts += ["nothing but quixotic here", *[f"commonword in text {i}" for i in range(60)]]
    got = {r.doc_id: r for r in private_data.find_private_data(docs_of(spark, texts, tmp_path)).collect()}
    marked = [{texts[i][s.start : s.end] for s in got[3 * i].spans or () if s.kind == 4} for i in range(len(texts))]
    assert all("quixotic" in marked[i] for i in range(5)), "far from the entity, and in a text without it"
    assert not any("commonword" in m for m in marked)
    whole = {w for t in texts for w in re.findall(r"\w+", t)}
    assert all(m <= whole and not m & {"secret", "host", "example"} for m in marked)


def test_line_chunks(spark, tmp_path):
    block = "\n".join(f"line number {i}" for i in range(40))
    got = {r.doc_id: r for r in line_dedup.remove_repeated_chunks(docs_of(spark, [*EDGES, block, "new\n" + block, None], tmp_path)).collect()}
    assert got[33].n_removed == 0 and got[36].n_removed >= 30
    assert got[33].kept == block and got[0].n_lines == 1


def test_licence_notices(spark, tmp_path):
    corpus = [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").limit(40).collect()]
    texts = [*EDGES, "Some text.\nReleased under the MIT License.", "é\nLicensed under the Apache License, Version 2.0.\nmore", *corpus[:20]]
    model = licenses.fit(sorted(line for t in corpus for line in t.split("\n") if "icense" not in line))
    got = {r.doc_id: r for r in licenses.scan_licenses(docs_of(spark, texts, tmp_path), model).collect()}
    assert got[33].families == "MIT" and got[33].spans == "MIT:11:42"
    assert got[36].families == "Apache" and got[36].spans.startswith("Apache:2:")
    assert all(got[3 * i].n_notices == 0 for i in range(len(EDGES)))


HELD_OUT = ("You may use these files under the {}.", "All examples here are covered by the {}.", "Published under {} terms.", "Source code: {}")
ONLY_MENTIONED = ("A talk about the {} opened the meeting.", "He never read the {} in full.", "Critics of the {} wrote many letters.")


def test_licence_wordings_kept_out_of_the_fit(spark, tmp_path):
    corpus = [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").limit(40).collect()]
    model = licenses.fit(sorted(line for t in corpus for line in t.split("\n") if "icense" not in line))
    named = [(family, name) for family, names in licenses.NAMES.items() for name in names if "SPDX" not in name]
    asked = [(family, w.format(name)) for family, name in named for w in HELD_OUT]
    asked += [("", w.format(name)) for _, name in named for w in ONLY_MENTIONED]
    known = [("MIT", "MIT license."), ("MIT", "SPDX-License-Identifier: MIT"), ("GPL", "GNU GPL v2 or later"), ("Apache", "Licensed under the Apache License 2.0")]
    asked += [*known, ("ISC", licenses.TEMPLATES["ISC"][0]), ("unknown", licenses.TEMPLATES["unknown"][1])]
    got = {r.doc_id: r.families for r in licenses.scan_licenses(docs_of(spark, [t for _, t in asked], tmp_path), model).collect()}
    right = [got[3 * i] == family for i, (family, _) in enumerate(asked)]
    held, mentions = len(named) * len(HELD_OUT), len(named) * len(ONLY_MENTIONED)
    assert all(right[held + mentions :])
    assert sum(right[:held]) >= 0.7 * held and sum(right[held : held + mentions]) >= 0.5 * mentions
    assert all(got[3 * i] in ("", "unknown", family) for i, (family, _) in enumerate(asked[:held]))


def test_the_classifier_decides_licences(spark, tmp_path):
    corpus = [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").limit(40).collect()]
    model = licenses.fit(sorted(line for t in corpus for line in t.split("\n") if "icense" not in line))
    prose = " ".join(f"word{i}" for i in range(400))
    docs = docs_of(spark, ["Released under the MIT License.", f"{prose} Released under the MIT License. {prose}"], tmp_path)
    none = {**model, "weights": np.zeros_like(model["weights"]), "bias": np.where(np.arange(len(model["bias"])) == 0, 9.0, 0.0).astype(np.float32)}
    other = {**none, "bias": np.where(np.arange(len(model["bias"])) == licenses.CLASSES.index("GPL"), 9.0, 0.0).astype(np.float32)}
    assert [r.families for r in licenses.scan_licenses(docs, none).collect()] == ["", ""]
    assert {r.families for r in licenses.scan_licenses(docs, other).collect()} == {"unknown"}
    assert {r.families for r in licenses.scan_licenses(docs, model).collect()} == {"MIT"}


def test_wrapped_and_enclosed_notices(spark, tmp_path):
    corpus = [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").limit(40).collect()]
    model = licenses.fit(sorted(line for t in corpus for line in t.split("\n") if "icense" not in line))
    header = licenses.TEMPLATES["BSD"][1].split()
    prose = " ".join(f"word{i}" for i in range(400))
    lesser = "This library is free software; you can\nredistribute it and/or modify it under the\nterms of the GNU Lesser General Public License\nas published by the Free Software Foundation."
    texts = ["# " + " ".join(header[:10]) + "\n# " + " ".join(header[10:]), f"\u00e9 {prose} Released under the MIT License. {prose}", lesser, prose]
    got = [r for _, r in sorted((r.doc_id, r) for r in licenses.scan_licenses(docs_of(spark, texts, tmp_path), model).collect())]
    assert [r.families for r in got] == ["BSD", "MIT", "LGPL", ""]
    assert got[0].spans == f"BSD:2:{len(texts[0])}" and got[2].spans == f"LGPL:0:{len(lesser)}"
    _, start, end = got[1].spans.split(":")
    assert texts[1][int(start) : int(end)] == "Released under the MIT License."


def test_top_k_edges(spark, tmp_path):
    random = np.random.default_rng(4)
    same = [0.5] * 8
    rows = [(i, same if i % 3 else random.normal(0, 0.4, 8).tolist()) for i in range(120)]
    rows += [(200, None), (201, [None] * 8), (202, [float("nan")] * 8), (203, [1.0, 2.0]), (50, same), (None, same)]
    path = str(tmp_path / "v.parquet")
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(path)
    got = topk_search.top_k(spark.read.parquet(path)).collect()
    usable = [(i, np.floor(256 * np.array(v))) for i, v in rows if v and None not in v and np.isfinite(v).all()]
    expected = []
    for at, (query, q) in enumerate(usable):
        if query is not None and query % 50 == 0:
            scored = sorted((-int(q @ v), i is None, i or 0) for k, (i, v) in enumerate(usable) if k != at and len(v) == len(q))[:5]
            expected += [(query, n + 1, None if none else i, -s) for n, (s, none, i) in enumerate(scored)]
    key = lambda r: (r[0], r[1], r[2] is None, r[2] or 0, r[3])
    assert sorted(((r.query_id, r["rank"], r.vec_id, r.score) for r in got), key=key) == sorted(expected, key=key)


def test_pipeline_runs(spark):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert rows and {r.doc_id for r in rows} <= {r.doc_id for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert corpus_pipeline.ORACLE_SQL is None


def test_long_words_and_windows_hash_alike(monkeypatch):
    from xylemflow.llm import hashing

    texts = pa.array([LONG, "tail"])
    flat, offsets = hashing.text_bytes(texts)
    whole = hashing.shingle_sets(flat, offsets, 5)[0]
    monkeypatch.setattr(hashing, "WINDOW", 1000)
    pieces = hashing.shingle_sets(flat[: offsets[1]], offsets[:2], 5)[0]
    assert np.array_equal(whole, pieces)


def test_top_k_keeps_vectors_with_large_components(spark):
    """Finite vectors take part whatever their size; products beyond exact doubles stay exact."""
    random = np.random.default_rng(12)
    rows = [(i, (random.integers(-50, 50, 6) * s).astype(float).tolist()) for i, s in enumerate([1, 9e6, 1e7, 1, 1e7, 1, 9e6] * 9)]
    rows += [(100, [1e300, 0.0, 0.0, 0.0, 0.0, 0.0]), (101, [float("inf")] * 6)]
    got = [tuple(r) for r in topk_search.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=25).collect()]
    most = 1 << 61
    whole = {i: [min(max(int(np.floor(256 * x)) if abs(x) < 1e290 else most * (1 if x > 0 else -1), -most), most) for x in v] for i, v in rows if i != 101}
    want = []
    for q in (0, 25, 50, 100):
        scored = sorted((-min(max(sum(a * b for a, b in zip(whole[q], v)), -(1 << 63)), (1 << 63) - 1), i) for i, v in whole.items() if i != q)[:5]
        want += [(q, rank, i, -score) for rank, (score, i) in enumerate(scored, 1)]
    assert sorted(got) == sorted(want)


def test_short_texts_are_hashed_together(monkeypatch):
    texts = [b"", b"short", bytes(range(40, 100)) * 2, b"x" * 49, bytes(range(60, 120)) * 3, b"y" * 50]
    column = pa.array([t.decode() for t in texts])
    calls, sums = [], substring_dedup.prefix_sums
    monkeypatch.setattr(substring_dedup, "prefix_sums", lambda b: calls.append(len(b)) or sums(b))
    rows = list(substring_dedup._slices(column))
    assert [(low, high) for low, high, _, _ in rows] == [(0, len(texts))]
    (_, _, flat, offsets), length = rows[0], substring_dedup.LENGTH
    at, bounds = substring_dedup._samples(offsets)
    hashes = substring_dedup._at(flat, at, substring_dedup.PREFIX) & substring_dedup.P.COARSE
    assert calls == [sum(map(len, texts))]
    # All samples named: every string of a row starts near one; none named: no string is a candidate.
    own = [np.sort(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
    wanted = [o + p for o, t in zip(offsets, texts) for p in range(len(t) - length + 1)]
    assert substring_dedup._candidates(flat, offsets, own).tolist() == wanted
    assert not len(substring_dedup._candidates(flat, offsets, [h[:0] for h in own]))


def test_packing_postings_takes_little_memory():
    import tracemalloc

    rng = np.random.default_rng(1)
    documents = [(i, np.sort(rng.integers(0, 1 << 63, 1 << 16).astype(np.uint64)), None, None) for i in range(32)]
    tracemalloc.start()
    try:
        packed = near_dedup.P.pack(iter(documents), 64, np.zeros(0, np.uint64))
        found = sum(len(cell.as_py()) // 8 for batch in packed for cell in batch.column(4))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found == 32 << 16 and peak < 64 << 20
