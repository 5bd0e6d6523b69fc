"""The corpus operators against brute force, on small tables with nulls, empty and long texts,
repeated rows, clashing extra columns, and on empty tables."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from strata.llm import (  # noqa: E402
    byte_bpe,
    embedding_join,
    fingerprints,
    language,
    mixing,
    ngram_join,
    token_counts,
    toxicity,
    url_filter,
    warc,
)

DOCS = "doc_id long, text string, lang string, source string, size long, component_id string, score string"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def _texts() -> list[str | None]:
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 6))) for _ in range(400)]
    made = [" ".join(rng.choice(words) for _ in range(rng.choice([3, 40, 60, 90]))) for _ in range(30)]
    near = []
    for t in made[:10]:
        w = t.split()
        w[rng.randrange(len(w))] = "changed"
        near += [" ".join(w), t, t + " tail", t.upper()]
    odd = [None, "", "   ", "one", "One", "a b c", "é ñ 日本語 \U0001f600", "x" * 3000, "ab " * 4000, "tab\tand\nline  end ", "<|endoftext|> it's 12", "ΑΣ İ ẞ"]
    return made + near + odd


@pytest.fixture(scope="module")
def rows() -> list[tuple[int, str | None]]:
    return list(enumerate(_texts()))


@pytest.fixture(scope="module")
def docs(spark, rows):
    data = [(i, t, ["en", "fr", None][i % 3], ["b", "a", None, "c"][i % 4], 7, "x", "y") for i, t in rows]
    return spark.createDataFrame(data, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def _words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def _set(text: str | None, width: int) -> set:
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in _words(text)]
    return {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def _components(sets: dict[int, set], linked) -> dict[int, int]:
    root = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and linked(a, b):
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = {k: new if v == old else v for k, v in root.items()}
    return root


def test_ngram_join_equals_all_pairs(docs, rows):
    sets = {i: _set(t, 4) for i, t in rows}

    def linked(a, b):
        both = len(sets[a] & sets[b])
        return both > 0 and 100 * both >= 85 * len(sets[a] | sets[b])

    root = _components(sets, linked)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.ngram_components(docs).collect()}
    assert got == {i: (len(sets[i]), root[i]) for i in sets}
    kept = ngram_join.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i in sets if root[i] == i}


def test_ngram_join_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 300)
    rng = random.Random(3)
    base = [[f"w{rng.randrange(40)}" for _ in range(rng.choice([30, 50, 60, 70, 90]))] for _ in range(12)]
    data = []
    for i in range(160):
        words = list(rng.choice(base))
        for _ in range(rng.randrange(5)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(9)}"
        data.append((i, " ".join(words[: len(words) - rng.randrange(12)])))
    sets = {i: _set(t, 4) for i, t in data}
    root = _components(sets, lambda a, b: 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]))
    found = ngram_join.ngram_components(spark.createDataFrame(data, "doc_id long, text string"))
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == root


@pytest.mark.parametrize("leaf", [2, 64])
def test_tree_join_finds_every_component(leaf, monkeypatch):
    monkeypatch.setattr(ngram_join, "LEAF", leaf)
    rng = np.random.default_rng(1)
    base = [rng.integers(0, 2**63, 60, dtype=np.uint64) << np.uint64(1) for _ in range(6)]
    sets = []
    for k in range(60):
        s = base[k % 6].copy()
        s[rng.choice(60, rng.integers(0, 12), replace=False)] = rng.integers(0, 2**63, dtype=np.uint64)
        sets.append(np.unique(s))
    root = np.arange(len(sets))
    ngram_join.tree_join(sets, np.arange(30), np.arange(30, 60), 85, root)
    want = {k: set(s.tolist()) for k, s in enumerate(sets)}
    across = _components(want, lambda a, b: a < 30 <= b and 100 * len(want[a] & want[b]) >= 85 * len(want[a] | want[b]))
    assert root.tolist() == [across[k] for k in range(60)]


def test_fingerprints_and_edited_texts(docs, rows):
    got = {r["doc_id"]: r for r in fingerprints.fingerprint_with_edits(docs).collect()}
    order = sorted(rows, reverse=True)
    texts = [t or "" for _, t in order]
    for k, (i, _) in enumerate(order):
        t, after = texts[k], texts[(k + 1) % len(texts)]
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        assert got[i]["n_chars"] == len(t)
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        a, b = _set(t, 5), _set(edited, 5)
        like = len(a & b) / len(a | b) if a | b else 1.0
        assert abs(got[i]["near_edited"] - like) < 0.2
        assert (got[i]["fingerprint"] == "") == (not a)
    by_text = {}
    for i, t in rows:
        by_text.setdefault(t or "", set()).add(got[i]["fingerprint"])
    assert all(len(f) == 1 for f in by_text.values())


def test_near_duplicates_are_verified(docs, rows):
    sets = {i: _set(t, 5) for i, t in rows}
    got = {r["doc_id"]: r["component_id"] for r in fingerprints.near_duplicates(docs).collect()}
    root = _components(sets, lambda a, b: bool(sets[a] & sets[b]) and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    assert all(root[i] == root[c] for i, c in got.items())  # no link without likeness
    assert sum(got[i] == root[i] for i in got) >= 0.9 * len(got)


def test_near_duplicates_of_a_hot_band_with_an_unlike_smallest_member(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 20000)
    shared = [f"s{k}" for k in range(200)]
    # 200 texts that share a passage (0.6 alike), then links among later ones: in each of their bands a text of the 200 is the smallest
    data = [(i, " ".join(shared + [f"own{i}x{k}" for k in range(60)])) for i in range(200)]
    data += [(200 + i, " ".join(shared + [f"late{i}x{k}" for k in range(12)])) for i in range(3)]
    data += [(270, data[9][1]), (271, data[9][1].upper()), (272, data[5][1]), (272, data[11][1])]
    table = spark.createDataFrame(data + [(None, data[3][1])], "doc_id long, text string").repartition(5)
    sets = [(i, _set(t, 5)) for i, t in data]
    root = {i: i for i, _ in data}
    for x, (i, a) in enumerate(sets):
        for y, (j, b) in enumerate(sets):
            if x < y and len(a & b) >= 0.8 * len(a | b):
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = {k: new if v == old else v for k, v in root.items()}
    assert root[202] == root[201] == 200 and root[272] == root[5] == root[11] and root[271] == 9 and root[1] == 1
    got = {r["doc_id"]: r["component_id"] for r in fingerprints.near_duplicates(table).collect()}
    assert got == root
    rows = fingerprints.fingerprints_and_components(table).collect()
    assert len(rows) == len(data) + 1 and all(r["component_id"] == root.get(r["doc_id"]) for r in rows)


def test_byte_bpe_equals_tiktoken_and_round_trips(docs, rows):
    import tiktoken

    ranks = byte_bpe.read_ranks(RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r["doc_id"]: r for r in byte_bpe.encode_decode(docs, RANKS, public_tokenizers.PATTERN).collect()}
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
    back = byte_bpe.decoded(byte_bpe.encoded(docs, RANKS, public_tokenizers.PATTERN), RANKS).collect()
    assert {r["doc_id"]: bytes(r["bytes"]).decode() for r in back} == {i: t or "" for i, t in rows}


def test_token_counts_equal_the_library(docs, rows):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORD_BPE)
    for r in token_counts.count_tokens(docs, WORD_BPE, limit=50).collect():
        text = rows[r["doc_id"]][1] or ""
        n = len(library.encode(text, add_special_tokens=False))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 50)


def test_mixing_fills_sources_by_weight(docs, rows):
    got = mixing.plan(docs).collect()
    size = {s: sum(len(_words(t)) for i, t in rows if ["b", "a", None, "c"][i % 4] == s) for s in ("a", "b", "c", None)}
    left, share, goal = dict(zip(("a", "b", "c", None), (3, 1, 2, 3), strict=True)), 1.5 * sum(size.values()), {}
    while True:  # share by weight, cut at twice the size, share the rest again
        level = share / sum(left.values())
        full = [s for s, w in left.items() if w * level > 2 * size[s]]
        if not full:
            goal |= {s: w * level for s, w in left.items()}
            break
        for s in full:
            goal[s] = 2 * size[s]
            share -= goal[s]
            del left[s]
    for r in got:
        assert r["target"] == pytest.approx(goal[r["source"]])
        assert r["size"] == len(_words(rows[r["doc_id"]][1])) and r["copies"] <= 2
    again = {r["doc_id"]: r["copies"] for r in mixing.plan(docs).collect()}
    assert again == {r["doc_id"]: r["copies"] for r in got}
    assert mixing.mixed(docs).columns == docs.columns and mixing.mixed(docs).count() == sum(again.values())


def test_embedding_components_equal_all_pairs(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(8, 6))
    data = []
    for k in range(120):
        v = base[k % 8] + rng.normal(size=6) * 0.09
        data.append((k, [float(x) for x in np.float32(v)], k % 3, "extra"))
    data += [(200, data[0][1], 0, "copy"), (201, [2 * x for x in data[0][1]], 0, "scaled"), (202, None, 0, ""), (203, [0.0] * 6, 0, ""),
             (204, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0, ""), (205, [float("nan")] * 6, 0, ""), (206, data[0][1], None, ""), (207, [1.0, 0.0], 0, ""),
             (208, [], 0, ""), (209, [float("inf")] * 6, 0, "")]
    table = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int, home string")
    fine = {i: (np.array(v, dtype=float), lab) for i, v, lab, _ in data
            if lab is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}

    def linked(a, b):
        if a not in fine or b not in fine or fine[a][1] != fine[b][1] or len(fine[a][0]) != len(fine[b][0]):
            return False
        x, y = fine[a][0], fine[b][0]
        return x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98

    root = _components({i: set() for i, *_ in data}, linked)
    count = {i: sum(linked(i, j) for j, *_ in data if j != i) for i, *_ in data}
    for cell in (embedding_join.CELL, 5):  # one cell, many cells
        try:
            old, embedding_join.CELL = embedding_join.CELL, cell
            got = embedding_join.embedding_components(table).collect()
        finally:
            embedding_join.CELL = old
        assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got} == {i: (count[i], root[i], root[i] == i) for i, *_ in data}


PAGES = "page_id long, url string, html string, host string"


def test_warc_round_trip(spark):
    data = [(1, None, None, ""), (2, "http://a.b/x\ny", "", ""), (3, "HTTP://U@Ex.COM:80/P?q", "x\r\n\r\ny\r", ""), (4, "u", "\r\n", ""), (None, "v", "q" * 1500, ""),
            (5, "v", "q" * 1500, ""), (6, "v", "q" * 1500, ""), (6, "v", "q" * 1500, ""), (7, "v", "\r" * 1200 + "é", ""), (8, "v", "\r" * 1200 + "é", ""), (9, "v", "q" * 999, ""), (10, "v", "q" * 999, "")]
    got = warc.archive(spark.createDataFrame(data, PAGES)).collect()
    want = []
    for i, _, html, _ in data:
        raw = (html or "").encode()
        same = [j for j, _, h, _ in data if (h or "").encode() == raw and j is not None]
        ref = max(same) if len(raw) >= 1000 and i is not None and max(same) != i else None
        want.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if ref else "response", ref))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=key) == sorted(want, key=key)
    order = [(r["url_key"], r["warc_date"], r["page_id"] or -1) for r in got]
    assert order == sorted(order)


def test_loser_tree_merges_runs():
    rng = random.Random(2)
    for k in (1, 2, 3, 7):
        runs = [sorted(rng.randrange(20) for _ in range(rng.randrange(9))) for _ in range(k)]
        assert [runs[r][p] for r, p in warc.LoserTree(runs)] == sorted(x for r in runs for x in r)


def test_url_rules_and_templates(spark):
    urls = [("http://X.example.org/es/1", "x.example.org", "/es/1", "example.org/es/", "block"), ("https://a.org/q?x", "a.org", "/q", "org/", "allow"),
            ("https://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"), ("s://example.org/en/2#t", "example.org", "/en/2", "org/", "allow"),
            ("http://borg", "borg", "", None, None), ("http://a.org", "a.org", "", None, None), (None, "", "", None, None), ("nothing", "", "", None, None)]
    many = [(f"http://s{k % 3}.com/de/{k}", None, None, "com/de/", "block") for k in range(60)] + [(f"http://s{k % 3}.com/de{k}", None, None, None, None) for k in range(6)]
    data = [(k, u[0], "", "h") for k, u in enumerate(urls + many)]
    got = {r["page_id"]: r for r in url_filter.judge(spark.createDataFrame(data, PAGES)).collect()}
    assert len(got) == len(data)
    for k, (_, host, path, rule, verdict) in enumerate(urls + many):
        assert got[k]["rule"] == rule and got[k]["verdict"] in ("allow", "block")
        assert host is None or (got[k]["host"], got[k]["path"]) == (host, path)
        assert verdict is None or got[k]["verdict"] == verdict
    assert all(got[k]["verdict"] == "block" for k in range(len(urls) + 60, len(data)))  # hosts whose labels are all blocked


def test_url_templates_at_any_number_of_siblings_and_depth(spark):
    rules = (("block", "com/de/"), ("allow", "com/s"), ("block", "deep.net/a/b/c/d/e/"), ("allow", "deep.net/a/b/c/d/f/"))
    urls = []
    for host, sections in (("few.com", 10), ("many.com", 45)):
        urls += [f"http://{host}/de/{w}" for w in "abcdefghijkl"] + [f"http://{host}/de"]
        urls += [f"http://{host}/s{chr(97 + k // 9)}{chr(97 + k % 9)}/{w}" for k in range(sections) for w in "xyz"]
    urls += [f"http://deep.net/a/b/c/d/{last}/{w}" for last in "ef" for w in "ghijklmnop"] + [f"http://deep.net/a/b/c/d/{last}" for last in "ef"]
    rows = url_filter.judge(spark.createDataFrame([(k, u, "", "") for k, u in enumerate(urls)], PAGES), rules).collect()
    got = {urls[r["page_id"]]: r["verdict"] for r in rows}
    assert len(rows) == len(urls)
    assert (got["http://few.com/de"], got["http://many.com/de"]) == ("block", "block")
    assert (got["http://deep.net/a/b/c/d/e"], got["http://deep.net/a/b/c/d/f"]) == ("block", "allow")


def _two_languages() -> list[tuple]:
    rng = random.Random(4)
    parts = {"en": ["the", "ing", "th", "wh", "er", "and"], "fr": ["eau", "que", "é", "ou", "les", "aux"]}
    out = []
    for i in range(240):
        lang = ("en", "fr")[i % 2]
        words = ["".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.choice([30, 60]))]
        if i % 4 < 2:
            for _ in range(3):
                words[rng.randrange(len(words))] = f"zqxw{rng.choice(list("aou"))}rk"
        out.append((i, " ".join(words), lang, i % 4 < 2))
    return out


def test_language_and_toxicity_on_held_out_rows(spark):
    data = _two_languages()
    table = spark.createDataFrame([(i, t, lang, "s", 0, "", "") for i, t, lang, _ in data] + [(900, None, "en", "", 0, "", ""), (901, "12 !", None, "", 0, "", "")], DOCS)
    got = {r["doc_id"]: r for r in language.identify(table).collect()}
    out = [i for i, *_ in data if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i, r in got.items() if r["held_out"] and i < 900} == set(out)
    assert all(got[i]["lang_pred"] == data[i][2] for i in out)
    assert got[900]["lang_pred"] == got[901]["lang_pred"] == "und"
    kept = language.keep_identified(table)
    assert kept.columns == table.columns and {r["doc_id"] for r in kept.collect()} == {i for i, *_ in data}

    labels = spark.createDataFrame([(i, 1, int(bad)) for i, *_, bad in data] + [(900, 1, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    scored = {r["doc_id"]: r for r in toxicity.toxicity(table, toxicity.train(table, labels)).collect()}
    assert len(scored) == len(data) + 2 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in scored.values())
    assert np.mean([scored[i]["predicted"] == int(data[i][3]) for i in out]) >= 0.9


def test_short_toxic_texts_on_held_out_rows(spark):
    """Texts of 8 or 60 words with two marked words."""
    rng = random.Random(4)
    parts = ["the", "ing", "th", "wh", "er", "and", "eau", "que", "é", "ou", "les", "aux"]
    data = []
    for i in range(400):
        words = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(rng.choice([8, 60]))]
        if i % 4 < 2:
            words[rng.randrange(len(words))] = words[-1] = f"zqxw{rng.choice(['a', 'o', 'u'])}rk"
        data.append((i, " ".join(words), int(i % 4 < 2)))
    table = spark.createDataFrame([r[:2] for r in data], "doc_id long, text string")
    labels = spark.createDataFrame([(i, bad) for i, _, bad in data], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(table, toxicity.train(table, labels)).collect()}
    for short in (True, False):
        out = [(i, bad) for i, t, bad in data if got[i]["held_out"] and (len(t.split()) == 8) == short]
        assert np.mean([got[i]["predicted"] for i, bad in out if bad]) >= 0.9
        assert np.mean([got[i]["predicted"] == bad for i, bad in out]) >= 0.9


def test_savings_are_differences_of_compressed_lengths():
    """Window by window, against the library's plain calls."""
    import pyarrow as pa

    model = toxicity.Model(b"plain words of some text", b"plain words of some text zqxzqx")
    texts = ["", "  ", "Some zqx, words", "x" * 300, "a " * 200 + "ZQX é"]
    data, offsets = toxicity.text_bytes(pa.array(texts))
    step = toxicity.WINDOW - toxicity.OVERLAP
    for text, saved in zip(texts, model.savings(data, offsets), strict=True):
        raw = b"".join(w + w + b" " for w in toxicity.fold(np.frombuffer(text.encode(), np.uint8)).tobytes().split())
        windows = [raw[k : k + toxicity.WINDOW] for k in range(0, max(len(raw) - toxicity.OVERLAP, 1), step)] if raw else []
        assert [len(w) for w in windows[-1:]] == [len(raw) - step * (len(windows) - 1)][: len(windows)]
        plain = [[len(toxicity._compressor(d).compress(w)) for w in windows] for d in (model.ordinary, model.toxic)]
        assert saved.tolist() == [a - b for a, b in zip(*plain, strict=True)]


def test_language_stage_rejects_letter_junk(spark):
    rng = random.Random(6)
    data = [(i, t, lang) for i, t, lang, _ in _two_languages()]
    junk = [(1000 + i, " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(40)), None)
            for i, letters in enumerate(["жщфыъэ", "漢字語文", "אבגדהו", "ქწერტყ"] * 3)]
    kept = language.keep_identified(spark.createDataFrame(data + junk, "doc_id long, text string, lang string"))
    assert {r["doc_id"] for r in kept.collect()} == {i for i, *_ in data}


def test_every_language_is_learned(spark):
    rng = random.Random(7)
    names = [f"x{a}{b}" for a in "abcdefgh" for b in "abcdefghi"]  # 72 languages, each with letters of its own
    data = []
    for k, lang in enumerate(names):
        own = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(4)) for _ in range(3)]
        data += [(k * 8 + i, " ".join(rng.choice(own) for _ in range(20)), lang) for i in range(8)]
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(spark.createDataFrame(data, "doc_id long, text string, lang string")).collect()}
    assert {lang for lang in got.values()} == set(names)
    assert np.mean([got[i] == lang for i, _, lang in data]) >= 0.95


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    pages = spark.createDataFrame([], PAGES)
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    made = [
        fingerprints.fingerprint_with_edits(empty), fingerprints.near_duplicates(empty), embedding_join.embedding_components(vectors),
        byte_bpe.encode_decode(empty, RANKS, public_tokenizers.PATTERN), toxicity.toxicity(empty, toxicity.train(empty, labels)),
        toxicity.keep_clean(empty, labels), ngram_join.ngram_components(empty), ngram_join.keep_one_of_each(empty), mixing.plan(empty),
        mixing.mixed(empty), token_counts.count_tokens(empty, WORD_BPE), warc.archive(pages), language.identify(empty),
        language.keep_identified(empty), url_filter.judge(pages),
    ]
    assert [df.count() for df in made] == [0] * len(made)


def test_null_and_repeated_ids(spark):
    data = [(None, "a b c d e f", None, None, 0, "", ""), (1, "a b c d e f", None, "s", 0, "", ""), (1, "a b c d e f", None, "s", 0, "", ""), (2, "A b c d e f", None, "s", 0, "", "")]
    table = spark.createDataFrame(data, DOCS)
    got = sorted(((r["doc_id"], r["component_id"]) for r in ngram_join.ngram_components(table).collect()), key=str)
    assert got == sorted([(None, None), (1, 1), (1, 1), (2, 1)], key=str)
    assert fingerprints.fingerprint_with_edits(table).count() == 4
    assert byte_bpe.encode_decode(table, RANKS, public_tokenizers.PATTERN).count() == 4
    assert token_counts.count_tokens(table, WORD_BPE).count() == 4
    assert language.identify(table).count() == 4 and mixing.plan(table).count() == 4


def test_the_mix_keeps_the_values_of_every_column(spark):
    rng = random.Random(12)
    schema = "doc_id long, text string, source string, size string, target int, copies string, source_size int, goal_source string, _copy int, key string, range int, draw double"
    data = [(k, " ".join("w" * rng.randint(0, 30)), rng.choice(["a", "b", None]), f"s{k}", k, f"c{k}", -k, f"g{k}", 7, f"k{k}", k % 3, 0.5) for k in range(60)]
    data += data[:4] + [(None, None, "a", None, None, None, None, None, None, None, None, None)]
    docs = spark.createDataFrame(data, schema).repartition(3)
    taken = {(r["doc_id"], r["source"]): r["copies"] for r in mixing.plan(docs).collect()}
    want = [row for row in data for _ in range(taken[row[0], row[2]])]
    got = mixing.mixed(docs)
    assert got.columns == docs.columns and len(want) > len(data)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


@pytest.mark.parametrize(("kind", "labels"), [
    ("string", ["1", "01", "x", None]), ("long", [1 << 40, -3, 0, None]), ("double", [float("nan"), 0.0, -0.0, None]),
    ("boolean", [True, False, True, None]), ("array<string>", [["a", "b"], ["a, b"], [], None]), ("date", None)])
def test_embedding_labels_of_any_type(spark, kind, labels):
    import datetime

    labels = labels or [datetime.date(2030, 1, 1), datetime.date(2030, 1, 2), datetime.date(1970, 1, 1), None]
    table = spark.createDataFrame([(8 * v + k, [1.0, 2.0 + v / 100], labels[k]) for v in range(3) for k in range(4)], f"vec_id long, embedding array<float>, label {kind}")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_join.embedding_components(table).collect()}
    same = (lambda a, b: a == b or (a != a and b != b)) if kind == "double" else (lambda a, b: type(a) is type(b) and a == b)
    for v in range(3):
        for k in range(4):
            mates = [8 * w + j for w in range(3) for j in range(4) if labels[j] is not None and same(labels[j], labels[k])]
            assert got[8 * v + k] == ((len(mates) - 1, min(mates)) if labels[k] is not None else (0, 8 * v + k))


def test_linked_sets_share_a_signature_or_are_known_to_be_thin():
    rng, draw = np.random.default_rng(0), random.Random(0)
    thin = 0
    for _ in range(4000):
        percent = draw.choice([60, 80, 85])
        a = draw.choice([draw.randint(1, 12), draw.randint(1, 100), draw.randint(1, 600), draw.randint(1, 5000)])
        b = draw.randint(-(-a * percent // 100), a)
        both = draw.randint(min(b, int(ngram_join.required_overlap(a, b, percent))), b)
        made = rng.integers(0, 1 << 63, size=a + b - both, dtype=np.uint64) << np.uint64(1)
        sets = [np.sort(made[:a]), np.sort(np.concatenate([made[:both], made[a:]]))]
        if 100 * both < percent * (a + b - both) or both == a == b:
            continue
        signatures: tuple[set, set] = set(), set()
        few = False
        for scheme, parts, differences, least in ngram_join.schemes(np.array([a, b]), percent):
            tokens, row, used = ngram_join._parted(sets, scheme, parts, least)
            for k in (0, 1):
                signatures[k].update(tokens[row == k].tolist())
            few |= bool(parts[0] > 0 and used[0] <= differences[0])
        thin += few
        assert few or signatures[0] & signatures[1], (a, b, both, percent)
    assert 0 < thin < 600


def test_short_sets_with_few_parts_are_joined_whole(spark):
    """Texts of a few words, where parts may coincide and prefixes must find the links."""
    rng = random.Random(5)
    base = [[f"w{rng.randrange(500)}" for _ in range(n)] for n in (9, 10, 11, 12, 13) for _ in range(60)]
    data = [" ".join(w) for w in base] + [" ".join([*w, "tail"]) for w in base]
    sets = {i: _set(t, 4) for i, t in enumerate(data)}
    root = _components(sets, lambda a, b: 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]))
    assert any(i != r for i, r in root.items())
    found = ngram_join.ngram_components(spark.createDataFrame(list(enumerate(data)), "doc_id long, text string"))
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == root
