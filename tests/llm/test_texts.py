"""Operators on texts against plain versions, and what they make of odd rows."""

import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import plainly
import pyarrow as pa
import public_tokenizers
import pytest
import regex
import tiktoken
from clicktally.llm import byte_pairs, languages, licences, near_duplicates, passages, quality
from clicktally.llm.codepoints import mixed as mixed_bits
from clicktally.llm.languages import with_languages
from clicktally.llm.line_runs import LineRuns, line_hashes, without_repeated_lines
from clicktally.llm.mixing import mixed, source_rates
from clicktally.llm.oracles import licence_scan
from clicktally.llm.quality import learn_quality, quality_udf
from clicktally.llm.shingles import shingle_hashes, word_hashes
from clicktally.llm.tables import is_held_out
from compare import duckdb_rows, spark_rows
from pyspark.sql import functions as F

RANKS = byte_pairs.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})

LONG = "Long words repeat " * 3000
ODD = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, None), (4, "one", "en", "a"), (5, "one", "en", "a"),
    (5, "one", "en", "a"), (None, "no number here at all", "en", "b"), (6, LONG, "en", "a"), (7, LONG + "end", "en", "b"),
    (8, "12345 !!! ...", None, "b"), (9, "x" * 30_000, "en", "a"), (10, "don't we'll 's ''s \U0001f600 中文", "en", "a"),
]


def varied(n, seed=0):
    """Documents of a small vocabulary: copies, near copies, shared lines and unrelated ones."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(400)]
    fresh = lambda k: " ".join(rng.choices(vocabulary, k=k))
    lines = [fresh(6) for _ in range(4)]
    texts = []
    for _ in range(n):
        kind = rng.random()
        if texts and kind < 0.2:
            texts.append(rng.choice(texts))
        elif texts and kind < 0.5:
            own = rng.choice(texts).split(" ")
            for _ in range(rng.randint(1, 6)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            texts.append(" ".join(own))
        else:
            texts.append("\n".join([fresh(rng.randint(1, 60)), rng.choice(lines).upper(), fresh(20)]))
    return [(i, text, "en", "s") for i, text in enumerate(texts)]


def test_words_are_cut_as_the_pattern_does():
    rng, pattern = random.Random(3), regex.compile(public_tokenizers.PATTERN)
    for _ in range(1500):
        rows = [(i, "".join(rng.choices("ab s'tremvld  \n\t 1２é中!?. 　'\U0001f600", k=rng.randint(0, 14)))) for i in range(4)]
        order, found, _, counts = byte_pairs._words_of(rows)
        wanted = [pattern.findall(text) for _, text in rows]
        assert [found[k] for k in order.tolist()] == sum(wanted, [])
        assert counts.tolist() == [len(own) for own in wanted]


def test_words_are_joined_as_the_library_does():
    rng = random.Random(5)
    for size in [*range(1, 30), 3000]:
        word = "".join(rng.choices("theaionsréüß中", k=size))
        assert byte_pairs.encode_word(word.encode(), RANKS) == LIBRARY._core_bpe.encode_single_piece(word.encode())


@pytest.mark.parametrize("chunk", [10, 1000, 10**7])
def test_byte_pairs_of_whole_documents(documents, chunk):
    rows = [*ODD, *varied(40)]
    got = byte_pairs.tokens(documents(rows), RANKS, chunk_chars=chunk).collect()
    key = lambda row: (row[0] is None, row[0] or 0, row[1])
    wanted = [(i, np.array(LIBRARY.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t, *_ in rows]
    assert sorted(((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in got), key=key) == sorted(wanted, key=key)


def test_byte_pair_digests_of_an_empty_table(documents):
    assert byte_pairs.token_digests(documents([]), RANKS).count() == 0


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_against_all_pairs(documents, size):
    rows = varied(160, seed=size)
    found = near_duplicates.near_duplicates(documents(rows), size).collect()
    wanted = plainly.near_documents([row[:2] for row in rows], size, 80)
    assert {r.doc_id: r.component_id for r in found} == wanted
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_crowded_buckets_are_compared_in_blocks(documents, monkeypatch):
    """A chain of texts, each near the next only: blocks of four rows must not lose a link."""
    words = [f"w{i}" for i in range(160)]
    rows = [(i, " ".join(words[2 * i : 2 * i + 60]), "en", "s") for i in range(50)]
    original = near_duplicates.block_pairs
    monkeypatch.setattr(near_duplicates, "block_pairs", lambda *a, **k: original(*a, **(k | {"block_rows": 4})))
    found = near_duplicates.near_duplicates(documents(rows), 2).collect()
    assert {r.doc_id: r.component_id for r in found} == plainly.near_documents([r[:2] for r in rows], 2, 80)


def test_near_duplicates_of_odd_rows(documents):
    found = {r.doc_id: r for r in near_duplicates.near_duplicates(documents(ODD), 2).collect()}
    assert {i: found[i].component_id for i in (1, 2, 3, 4, 5, 7)} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 7: 7}
    assert found[1].n_shingles == 0 and found[4].n_shingles == 1
    assert found[None].kept and found[None].component_id is None
    assert near_duplicates.near_duplicates(documents([])).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 2**63, 1000).astype(np.uint64)
    a, b = pool[:900], pool[100:]
    same = (near_duplicates.signature(a, 512) == near_duplicates.signature(b, 512)).mean()
    assert abs(same - 0.8) < 0.06


def test_lines_against_a_plain_version(documents):
    rows = [*varied(120), (500, "A shared line of twenty\nx", "en", "s"), (501, " a shared LINE of twenty", "en", "s"),
            (502, "a shared line of twenty\t", "en", "s"), (None, "a shared line of twenty", "en", "s"), (503, None, "en", "s")]
    got = without_repeated_lines(documents(rows)).select("row.doc_id", "lines.*").collect()
    wanted = plainly.without_lines([row[:2] for row in rows])
    assert sorted(map(tuple, got), key=repr) == sorted(wanted, key=repr)
    assert without_repeated_lines(documents([])).count() == 0


def test_runs_hold_different_hashes_and_are_compacted(spark, documents):
    hashes = line_hashes(documents(varied(60)), 20)
    runs = LineRuns(spark)
    for batch in range(7):
        runs.add(hashes.filter(F.pmod("doc_id", F.lit(7)) == batch))
    assert [len(level) for level in runs.levels] == [1, 2]
    assert runs.rows().count() == runs.rows().select("hash").distinct().count() == hashes.select("hash").distinct().count()
    runs.close()


def test_mix_meets_its_targets(documents):
    rows = [(i, "word " * 20, "en", "big" if i % 3 else "small") for i in range(3000)]
    weights = {"big": 1.0, "small": 3.0}
    out = mixed(documents(rows), weights).select("row.*").groupBy("source").count().collect()
    got = {r["source"]: r["count"] for r in out}
    assert abs(got["small"] / 2250 - 1) < 0.08 and abs(got["big"] / 750 - 1) < 0.12
    rates = {r.source: r.rate for r in source_rates(documents(rows), weights).collect()}
    assert rates == {"big": pytest.approx(0.375), "small": pytest.approx(2.25)}
    assert mixed(documents(rows), {"big": 1.0}).filter("row.source = 'small'").count() == 0


def test_mix_of_large_rates_and_odd_rows(documents):
    rows = [(0, "tiny", "en", "rare")] + [(i, "word " * 200, "en", None) for i in range(1, 40)]
    once = mixed(documents(rows), {"rare": 1.0})
    assert once.count() == pytest.approx(39 * 1000 / 4, rel=0.1)
    assert once.select("place").distinct().count() == once.count()
    assert mixed(documents(ODD)).count() >= 0
    assert mixed(documents([])).count() == 0


def test_mix_of_rows_without_own_numbers(documents):
    """Equal and different rows without a number, or with a shared one, draw each for itself."""
    rows = [(None, "word " * 20, "en", "s")] * 600 + [(None, f"word {i} " * 10, "en", "s") for i in range(600)]
    rows += [(7, "same " * 20, "en", "s")] * 600 + [(10_000 + i, "word " * 20, "en", "t") for i in range(1800)]
    once = mixed(documents(rows), {"s": 1.0, "t": 3.0})
    out = once.collect()
    kinds = [lambda r: r.row.text == "word " * 20 and r.row.doc_id is None, lambda r: r.row.doc_id is None and r.row.text != "word " * 20,
             lambda r: r.row.doc_id == 7]
    rate = {r.source: r.rate for r in source_rates(documents(rows), {"s": 1.0, "t": 3.0}).collect()}["s"]
    for kind in kinds:
        assert abs(sum(map(kind, out)) / (600 * rate) - 1) < 0.2
    assert len({r.place for r in out}) == len(out)
    again = mixed(documents(rows).repartition(3), {"s": 1.0, "t": 3.0}).collect()
    assert sorted((r.place, r.row.text) for r in again) == sorted((r.place, r.row.text) for r in out)


def test_licences_in_long_and_short_texts(documents):
    filler = " ".join(f"word{i}" for i in range(500))
    header = licences.NOTICES["GPL-3.0-header"]
    rows = [(1, f"{filler} {licences.NOTICES['MIT']} {filler}", "en", "s"), (2, licences.NOTICES["MIT"].upper(), "en", "s"),
            (3, f"{filler}\n{header.replace(' ', '  ')}\n{filler}", "en", "s"), (4, filler, "en", "s"),
            (5, "Released under the", "en", "s"), *ODD]
    found = licences.licence_matches(documents(rows)).collect()
    assert {(r.doc_id, r.licence) for r in found} == {(1, "MIT"), (2, "MIT"), (3, "GPL-3.0-header")}
    assert all(r.containment == 1.0 for r in found)
    assert licences.licence_matches(documents([])).count() == 0


def test_licences_shorter_than_a_shingle(documents):
    filler = " ".join(f"word{i}" for i in range(500))
    rows = [(1, f"{filler} All rights reserved. {filler}", "en", "s"), (2, "ALL RIGHTS RESERVED", "en", "s"),
            (3, "All rights were reserved", "en", "s"), (4, filler, "en", "s"), (5, "All rights", "en", "s"), *ODD]
    found = licences.licence_matches(documents(rows)).collect()
    assert sorted((r.doc_id, r.licence, r.first_word) for r in found) == [
        (1, "All-rights-reserved", 499), (2, "All-rights-reserved", 0)
    ]
    assert all(r.containment == 1.0 for r in found)


def test_every_short_notice_of_the_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = licences.licence_matches(docs).filter("licence = 'All-rights-reserved'").select("doc_id").collect()
    wanted = docs.filter("contains(lower(text), 'all rights reserved')").select("doc_id").collect()
    assert sorted(found) == sorted(wanted) != []


@pytest.mark.parametrize("sign", ["# ", " * ", "//", "-- ", "% ", "; ", "> "])
def test_licence_headers_in_code_comments(documents, sign):
    own = licences.NOTICES["GPL-3.0-header"].split()
    header = "\n".join(sign + " ".join(own[at : at + 7]) for at in range(0, len(own), 7))
    rows = [(1, f"/*\n{header}\n*/\nint main() {{ return 0; }}", "en", "s")]
    found = licences.licence_matches(documents(rows)).collect()
    assert [(r.licence, r.containment) for r in found] == [("GPL-3.0-header", 1.0)]


def test_notices_of_every_length_against_sql(spark, documents):
    """Short notices, comment signs, signs alone and words with signs inside, by the rule the SQL states."""
    rng = random.Random(4)
    signs = [" ", "\n", "\n# ", "\n * ", " // ", "--", ", ", "\t-\t", "\n%% ", " | ", " ~ "]
    rows = []
    for i, notice in enumerate(sorted(licences.NOTICES.values()) * 3):
        own = notice.split()
        text = "".join(w.upper() + rng.choice(signs) if rng.random() < 0.2 else w + rng.choice(signs[:7]) for w in own)
        rows.append((i, f"left {text} right all rights, reserved // here", "en", "s"))
    rows += [(90, None, "en", "s"), (91, "", "en", "s"), (92, "all rights", "en", "s"), (93, "ALL--RIGHTS#RESERVED", "en", "s")]
    docs = documents(rows)
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    assert spark_rows(licences.licence_matches(docs)) == duckdb_rows(con, licence_scan(licences.NOTICES))


def test_passages_wherever_they_stand(documents):
    rng = random.Random(1)
    fresh = lambda k: " ".join("".join(rng.choices("abcdefghijklmn", k=6)) for _ in range(k))
    rows = [(i, fresh(rng.randint(60, 400)), "en", "s") for i in range(60)]
    planted = {}
    for k in range(12):
        passage = fresh(51)
        for i in (100 + k, 200 + k):
            own = fresh(150).split()
            at = rng.randrange(150)
            rows.append((i, " ".join(own[:at] + passage.split() + own[at:]), "en", "s"))
            planted[i] = at
    found = passages.repeated_passages(documents(rows)).collect()
    assert {r.doc_id for r in found} == set(planted)
    for r in found:
        # A paragraph that differs in one word at its end is still similar enough.
        assert planted[r.doc_id] - 2 <= r.first_word and r.end_word <= planted[r.doc_id] + 53
        assert r.kept == (r.doc_id < 200)


def test_passages_are_covered_whole(documents):
    """Pasted passages of 23 words and more are found to the word, and so are whole short texts."""
    rng = random.Random(2)
    fresh = lambda k: ["".join(rng.choices("abcdefghijklmn", k=6)) for _ in range(k)]
    rows, planted = [], {}
    for k, size in enumerate([23, 24, 27, 31, 40, 51, 60, 100] * 3):
        passage = fresh(size)
        for i in (1000 + k, 2**40 + k, -5 - k):
            own, at = fresh(150), rng.randrange(150)
            rows.append((i, " ".join(own[:at] + passage + own[at:]), "en", "s"))
            planted[i] = [(at, at + size)]
    for k, size in enumerate([16, 17, 20, 30] * 3):
        line = " ".join(fresh(size))
        for i, text in ((3000 + k, line), (4000 + k, line), (5000 + k, f"{' '.join(fresh(40))}\n{line}\n{' '.join(fresh(40))}")):
            rows.append((i, text, "en", "s"))
            planted[i] = [(0, size)] if i < 5000 else [(40, 40 + size)]
    found = {}
    for r in passages.repeated_passages(documents(rows)).collect():
        found.setdefault(r.doc_id, []).append((r.first_word, r.end_word))
        assert r.kept == (r.doc_id < 0 or 3000 <= r.doc_id < 4000)
    assert found == planted


def test_unshared_words_between_two_passages_stay(documents):
    rng = random.Random(4)
    fresh = lambda k: ["".join(rng.choices("abcdefghijklmn", k=6)) for _ in range(k)]
    a, b = fresh(40), fresh(40)
    rows = [(i, " ".join(fresh(30) + a + fresh(10) + b + fresh(30)), "en", "s") for i in range(2)]
    found = passages.repeated_passages(documents(rows)).collect()
    assert sorted((r.doc_id, r.first_word, r.end_word) for r in found) == [(i, *x) for i in range(2) for x in ((30, 70), (80, 120))]


def test_near_copies_of_lines(documents):
    """One changed word in the middle of 60 is a similarity of 0.84; a band is missed with 0.008."""
    rng = random.Random(6)
    fresh = lambda k: ["".join(rng.choices("abcdefghijklmn", k=6)) for _ in range(k)]
    rows = []
    for k in range(10):
        line = fresh(60)
        rows.append((k, " ".join(line), "en", "s"))
        rows.append((100 + k, " ".join(fresh(20)) + "\n" + " ".join(line[:30] + ["changed"] + line[31:]), "en", "s"))
    found = passages.repeated_passages(documents(rows)).collect()
    whole = {r.doc_id for r in found if r.end_word - r.first_word == 60}
    assert whole == {row[0] for row in rows}


def test_short_lines_and_texts(documents):
    """Five equal lines or texts of twelve words are found; seven words are no paragraph."""
    rng = random.Random(8)
    fresh = lambda k: " ".join("".join(rng.choices("abcdefghijklmn", k=6)) for _ in range(k))
    line, text, short = fresh(12), fresh(12), fresh(7)
    rows = [(i, f"{fresh(40)}\n{line.upper()}\n{fresh(40)}", "en", "s") for i in range(5)]
    rows += [(10 + i, text.replace(" ", "  "), "en", "s") for i in range(5)]
    rows += [(20 + i, f"{fresh(30)}\n{short}\n{fresh(30)}", "en", "s") for i in range(5)] + [(30, short, "en", "s"), (31, short, "en", "s")]
    found = sorted((r.doc_id, r.first_word, r.end_word, r.kept) for r in passages.repeated_passages(documents(rows)).collect())
    assert found == [(i, 40, 52, i == 0) for i in range(5)] + [(10 + i, 0, 12, i == 0) for i in range(5)]


def shared_words(rows, size, inner=0):
    """The words of each document that lie in a stretch of ``size`` words or more which another document holds,
    without ``inner`` words at either end of a longest one."""
    holders, split = {}, {i: plainly.words(text) for i, text, *_ in rows}
    for i, own in split.items():
        for k in range(len(own) - size + 1):
            holders.setdefault(tuple(own[k : k + size]), []).append((i, k))
    covered = {i: set() for i in split}
    for i, own in split.items():
        for k in range(len(own) - size + 1):
            for j, at in holders[tuple(own[k : k + size])]:
                if i == j or (k and at and own[k - 1] == split[j][at - 1]):
                    continue  # not another document, or not where the stretch starts
                n = size
                while k + n < len(own) and at + n < len(split[j]) and own[k + n] == split[j][at + n]:
                    n += 1
                covered[i].update(range(k + inner, k + n - inner))
    return covered


def test_passages_against_all_stretches(documents, monkeypatch):
    """Of a stretch of 23 words and more that any two documents share, only words among the eleven at an end may be
    missed, and only where the first document with the window there lacks them; nothing unshared is reported."""
    rng = random.Random(11)
    fresh = lambda k: ["".join(rng.choices("abcdefghijklmn", k=5)) for _ in range(k)]
    pool = [fresh(rng.randint(15, 70)) for _ in range(12)]
    rows = []
    for i in range(120):
        words = []
        for _ in range(rng.randint(1, 6)):
            part = rng.choice(pool) if rng.random() < 0.5 else fresh(rng.randint(1, 50))
            at = rng.randint(0, len(part) - 1)
            words += part[at : at + rng.randint(1, len(part))]
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", "\n" if rng.random() < 0.1 else " "]) for w in words)
        rows.append((rng.randint(-(2**40), 2**40), text, "en", "s"))
    inner, whole, short = shared_words(rows, 23, inner=11), shared_words(rows, 23), shared_words(rows, 8)
    for block in (1_000_000, 700):
        monkeypatch.setattr(passages, "BLOCK_CHARS", block)
        found = {i: set() for i in inner}
        for r in passages.repeated_passages(documents(rows), percent=100).collect():
            found[r.doc_id].update(range(r.first_word, r.end_word))
        for i, own in found.items():
            assert inner[i] <= own, (block, i, sorted(inner[i] - own))
            assert own <= short[i], (block, i, sorted(own - short[i]))
        missed = sum(len(whole[i] - own) for i, own in found.items())
        assert missed <= 0.05 * sum(map(len, whole.values()))


def paragraphs_of(text):
    lines = [plainly.words(line) for line in (text or "").split("\n")]
    long = [own for own in lines if len(own) >= 8]
    whole = plainly.words(text)
    return long or ([whole] if len(whole) >= 8 else [])


def test_near_paragraphs_against_all_pairs(documents):
    """Lines at a similarity of 0.8 and more: nearly all are found whole, and no other line is."""
    rng = random.Random(12)
    fresh = lambda k: ["".join(rng.choices("abcdefghijklmn", k=5)) for _ in range(k)]
    rows, base = [], [fresh(rng.randint(30, 120)) for _ in range(40)]
    for i, line in enumerate(base * 3):
        own = list(line)
        for _ in range(rng.choice([0, 1, 1, 2, 6])):
            own[rng.randrange(len(own))] = "changed"
        rows.append((i, "\n".join([" ".join(fresh(20)), " ".join(own), " ".join(fresh(9))]), "en", "s"))
    sets = [(i, k, plainly.shingles(" ".join(own), 5)) for i, text, *_ in rows for k, own in enumerate(paragraphs_of(text))]
    near = {
        i for i, k, a in sets if k == 1 for j, other, b in sets if i != j and other == 1 and len(a & b) >= 0.8 * len(a | b)
    }
    sizes = {i: len(paragraphs_of(text)[1]) for i, text, *_ in rows}
    found = passages.repeated_passages(documents(rows)).collect()
    whole = {r.doc_id for r in found if r.first_word <= 20 and r.end_word >= 20 + sizes[r.doc_id]}
    assert len(near & whole) >= 0.95 * len(near) > 40
    assert all(r.first_word >= 20 and r.end_word <= 20 + sizes[r.doc_id] for r in found)


def test_no_link_between_paragraphs_is_lost(documents, monkeypatch):
    """Lines of eight words and more at a similarity of exactly 0.8 and more, short ones too, are all found whole."""
    rng = random.Random(21)
    fresh = lambda k: ["".join(rng.choices("abcdefghijklmn", k=5)) for _ in range(k)]
    common = fresh(9)  # in many lines that are not similar
    lines = []
    for size in [*range(8, 24), *range(24, 70, 4)] * 4:
        line = fresh(size)
        if rng.random() < 0.3:
            line = line[:4] + common + line[4:]
        lines += [line, line + fresh((size - 4) // 4), line[1:] if rng.random() < 0.5 else line[:-1] + fresh(1)]
        lines.append(line[: size // 2] + fresh(1) + line[size // 2 :])
    rows = [(i, " ".join(line), "en", "s") for i, line in enumerate(lines)]
    sets = [plainly.shingles(text, 5) for _, text, *_ in rows]
    near = {
        i for i, a in enumerate(sets) for j, b in enumerate(sets)
        if i != j and min(len(lines[i]), len(lines[j])) >= 8 and 10 * len(a & b) >= 8 * len(a | b)
    }
    exact = [i for i, a in enumerate(sets) for b in sets if 10 * len(a & b) == 8 * len(a | b)]
    assert len(exact) > 20 and sum(len(lines[i]) < 16 for i in near) > 40
    for block in (1_000_000, 700):
        monkeypatch.setattr(passages, "BLOCK_CHARS", block)
        found = passages.repeated_passages(documents(rows)).collect()
        whole = {r.doc_id for r in found if (r.first_word, r.end_word) == (0, len(lines[r.doc_id]))}
        assert near <= whole, [len(lines[i]) for i in sorted(near - whole)]


def test_shared_keys_over_batches():
    """Keys that several documents have, however the sorted rows fall into batches."""
    rng = random.Random(22)
    for size in (1, 2, 3, 7, 100):
        rows = sorted((rng.randint(0, 20), rng.randint(0, 1), rng.choice([1, 1, 1, 2, 9]), k, 0) for k in range(60))
        docs = {}
        for key, check, doc_id, *_ in rows:
            docs.setdefault((key, check), set()).add(doc_id)
        wanted = [(d, key, first, n, d == min(docs[key, c])) for key, c, d, first, n in rows if len(docs[key, c]) > 1]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32()]
        batches = [
            pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows[i : i + size], strict=True), kinds, strict=True)], names=list("abcde"))
            for i in range(0, len(rows), size)
        ]
        found = [tuple(row.values()) for batch in passages._shared(iter(batches)) for row in batch.to_pylist()]
        assert found == wanted


def test_similar_paragraphs_are_compared_in_one_bucket(documents, monkeypatch):
    """Two or three similar lines meet once for each hash that they share, but are compared once."""
    rng = random.Random(24)
    fresh = lambda k: ["".join(rng.choices("abcdefghijklmn", k=6)) for _ in range(k)]
    rows = []
    for k in range(10):
        line = fresh(120)
        for i in range(2 + k % 2):
            rows.append((10 * k + i, " ".join(line[: 40 * i] + fresh(1) + line[40 * i + 1 :]), "en", "s"))
    compared, block_pairs = [], passages.block_pairs

    def counted(members, *args, **kwargs):
        compared.append(members.count())
        return block_pairs(members, *args, **kwargs)

    monkeypatch.setattr(passages, "block_pairs", counted)
    found = passages.repeated_passages(documents(rows)).collect()
    assert {(r.doc_id, r.first_word, r.end_word) for r in found} == {(i, 0, 120) for i, *_ in rows}
    met, once = compared
    # Three may also meet in twos: nine rows at most.
    assert met > 200 and 2 * 5 + 3 * 5 <= once <= 2 * 5 + 9 * 5


def test_hashes_and_sets_against_plain_versions():
    rng = random.Random(25)
    signs = "aAbZz \n\t\x0b.éÉß中\U0001f600\ud800Àñ[@`{"
    words = passages.Words([])
    for _ in range(100):
        texts = ["".join(rng.choices(signs, k=rng.randint(0, 60))) + rng.choice(["", "Q" * 40, "É" * 40 + "Zy"]) for _ in range(4)]
        words, plain = passages.Words(texts), word_hashes(texts)
        assert words.hashes.tolist() == np.concatenate(plain).tolist()
        assert np.diff(words.bounds).tolist() == [len(own) for own in plain]
        if len(words.hashes) >= 5:
            assert words.shingles.tolist() == shingle_hashes(words.hashes, 5).tolist()
    # Equal in all bits that fit beside the number of a stretch, or not.
    runs = np.array([5, 4, 1, 1, 2**63 + 1, 2**63, 2**63 + 3, 2**63, 7], np.uint64)
    sets = passages._Sets(runs, np.array([0, 3, 3, 4]), np.array([5, 0, 4, 5]))
    wanted = [sorted(set(runs[a:b].tolist())) for a, b in ((0, 5), (3, 3), (3, 7), (4, 9))]
    assert [sets.own[a:b].tolist() for a, b in zip(sets.bounds[:-1], sets.bounds[1:], strict=True)] == wanted
    asked = [(k, h) for k in range(4) for h in sorted(set(runs.tolist()) | {0, 2**63 + 2, 2**64 - 1})]
    ranks, there = sets.ranks(np.array([k for k, _ in asked]), np.array([h for _, h in asked], np.uint64))
    assert there.tolist() == [h in wanted[k] for k, h in asked]
    assert all(wanted[k][rank] == h for (k, h), rank, found in zip(asked, ranks.tolist(), there, strict=True) if found)


def test_a_text_longer_than_a_block(documents, monkeypatch):
    """A text of more code points than a block, beside small ones, gives what it gives in one block."""
    rng = random.Random(13)
    fresh = lambda k: " ".join("".join(rng.choices("abcdefghijklmn", k=6)) for _ in range(k))
    passage = fresh(60)
    rows = [(i, fresh(20), "en", "s") for i in range(5)] + [(10, f"{fresh(3000)} {passage} {fresh(3000)}", "en", "s"), (11, passage, "en", "s")]
    wanted = [(10, 3000, 3060, True), (11, 0, 60, False)]
    for block in (1_000_000, 1000):
        monkeypatch.setattr(passages, "BLOCK_CHARS", block)
        found = passages.repeated_passages(documents(rows)).collect()
        assert sorted((r.doc_id, r.first_word, r.end_word, r.kept) for r in found) == wanted


def test_passages_of_odd_rows(documents):
    found = passages.repeated_passages(documents(ODD)).collect()
    assert {(r.doc_id, r.kept) for r in found} == {(6, True), (7, False)}
    assert passages.repeated_passages(documents([])).count() == 0


def test_quality_of_no_documents_and_of_large_bags(spark, documents):
    """An empty table gives no model and no scores; what the driver holds is bounded in bytes, however long the texts."""
    schema = "doc_id long, quality int"
    assert learn_quality(documents([]), spark.createDataFrame([], schema), F.lit(True)) is None
    assert documents([]).select(quality_udf(None, spark)("text")).count() == 0
    rng = random.Random(5)
    text = lambda k: " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(k))
    rows = [(i, text(3000 if i % 2 else 20), "en", "s") for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], schema)
    learned = []
    original = quality.train
    quality_train = lambda bags, *a, **k: learned.append(sum(b.nbytes + w.nbytes for b, w in bags)) or original(bags, *a, **k)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(quality, "train", quality_train)
        for most in (10**9, 300_000, 1):
            assert learn_quality(documents(rows), labels, F.lit(True), max_bag_bytes=most) is not None
    assert learned[0] > 400_000 and learned[1] <= 300_000 and 0 < learned[2] < learned[1]


SENTENCES = {
    "en": "the people of this town were walking through their green fields with all of those things",
    "fr": "les gens de cette ville marchaient dans leurs champs verts avec toutes ces choses nouvelles",
    "de": "die leute dieser stadt gingen durch ihre gruenen felder mit allen diesen schoenen dingen",
}


def test_languages_and_mixtures(documents):
    rows = [(i, text, lang, "s") for i, (lang, text) in enumerate(SENTENCES.items())]
    asked = [(10, "walking with those people", None, "s"), (11, " ".join([SENTENCES["fr"]] * 3 + [SENTENCES["de"]]), None, "s"),
             *((20 + k, *row[1:]) for k, row in enumerate(ODD[:3])), (30, "12 34 !!", None, "s")]
    docs = documents([*rows, *asked])
    found = {r.row.doc_id: r.language for r in with_languages(docs, F.col("doc_id") < 10).collect()}
    assert [found[i].lang for i in range(3)] == list(SENTENCES)
    assert found[10].lang == "en"
    assert (found[11].lang, found[11].n_languages) == ("fr", 2) and 0.6 < found[11].score < 0.9
    for i in (20, 21, 22, 30):
        assert (found[i].lang, found[i].score) == ("und", 0.0)
    assert {r.language.lang for r in with_languages(docs, F.lit(False)).collect()} == {"und"}


def test_mixtures_of_four_languages(documents):
    more = SENTENCES | {"es": "la gente de este pueblo caminaba por sus campos verdes con todas aquellas cosas hermosas"}
    rows = [(i, text, lang, "s") for i, (lang, text) in enumerate(more.items())]
    rows.append((10, " ".join(" ".join([text] * 3) for text in more.values()), None, "s"))
    found = {r.row.doc_id: r.language for r in with_languages(documents(rows), F.col("doc_id") < 10).collect()}
    assert found[10].n_languages == 4 and set(found[10].languages) == set(more)
    assert all(0.15 < share < 0.35 for share in found[10].shares) and sum(found[10].shares) == pytest.approx(1, abs=0.01)
    assert (found[10].lang, found[10].score) == (found[10].languages[0], found[10].shares[0])
    assert (found[0].languages, found[0].shares) == (["en"], [1.0])


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = with_languages(docs, ~is_held_out()).filter(is_held_out("row.doc_id"))
    right, total = found.agg(F.count_if(F.col("row.lang") == F.col("language.lang")), F.count(F.lit(1))).first()
    assert right >= 0.98 * total > 0


def test_quality_of_held_out_documents(spark, documents):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = learn_quality(docs, labels, ~is_held_out())
    scored = docs.join(labels, "doc_id").filter(is_held_out()).select("quality", quality_udf(model, spark)("text").alias("p"))
    right, total = scored.agg(F.count_if((F.col("p") >= 0.5) == (F.col("quality") == 1)), F.count(F.lit(1))).first()
    assert right >= 0.95 * total > 0
    odd = documents(ODD).select(quality_udf(model, spark)("text").alias("p")).collect()
    assert len(odd) == len(ODD) and all(0 <= r.p <= 1 for r in odd)
    assert learn_quality(docs, labels.limit(0), F.lit(True)) is None
    assert {r.p for r in documents(ODD).select(quality_udf(None, spark)("text").alias("p")).collect()} == {0.5}


def test_digests_are_those_of_the_parts(documents):
    (row,) = byte_pairs.token_digests(documents([(1, "abc", "en", "s")]), RANKS).collect()
    ids = np.array(LIBRARY.encode_ordinary("abc"), "<u4").tobytes()
    assert (row.n_tokens, row.ids_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())


@pytest.mark.parametrize("hashes", [lambda sizes: sizes % 3, lambda sizes: sizes])
def test_words_with_equal_hashes_are_told_apart(monkeypatch, hashes):
    rows = [(1, "one two six ten one two"), (2, ""), (3, "six one\n\nfour nine ten" * 3)]
    monkeypatch.setattr(byte_pairs, "span_hashes", lambda chars, starts: hashes(np.diff(np.append(starts, len(chars)))).astype(np.uint64))
    order, words, found, counts = byte_pairs._words_of(rows)
    assert len(set(words)) == len(words) == len(found)
    ends = np.cumsum(counts)
    assert ["".join(words[k] for k in order[b - n : b]) for n, b in zip(counts, ends, strict=True)] == [t for _, t in rows]


def test_trigrams_and_mixtures_against_plain_versions():
    sentences = [*SENTENCES.values(), "die stadt; the fields, zwölf Hügel 7 x"]
    grams = languages.trigrams([*sentences, ""])
    for text, (buckets, counts) in zip([*sentences, ""], grams, strict=True):
        runs = Counter(plainly.trigrams(text))
        keys = np.array([sum(ord(c) << s for c, s in zip(run, (42, 21, 0), strict=True)) for run in runs], np.uint64)
        wanted = Counter()
        for bucket, n in zip((mixed_bits(keys) >> np.uint64(64 - languages.BUCKET_BITS)).tolist(), runs.values(), strict=True):
            wanted[bucket] += n
        assert dict(zip(buckets.tolist(), counts.tolist(), strict=True)) == wanted
    table = np.full((3, 1 << languages.BUCKET_BITS), 0.5)
    for k in range(3):
        table[k, grams[k][0]] += grams[k][1]
    table = np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)
    rng, lists = random.Random(3), [text.split() for text in SENTENCES.values()]
    asked = languages.trigrams([" ".join(rng.choice(lists[rng.randrange(1 + i % 3)]) for _ in range(1 + 2 * i)) for i in range(40)])
    sizes = set()
    for (buckets, counts), found in zip(asked, languages.mixtures(asked, table), strict=True):
        wanted = plainly.mixture(counts.tolist(), table[:, buckets].T.tolist())
        assert [k for k, _ in found] == [k for k, _ in wanted]
        assert [share for _, share in found] == pytest.approx([share for _, share in wanted], abs=1e-3)
        sizes.add(len(found))
    assert sizes >= {1, 2}


def test_more_languages_than_allowed(documents):
    docs = documents([(i, "some words", f"l{i}", "s") for i in range(5)])
    with pytest.raises(ValueError, match="more than 4 languages"):
        languages.learn_languages(docs, F.lit(True), max_languages=4)
    names, table = languages.learn_languages(docs, F.lit(True), max_languages=5)
    assert names == [f"l{i}" for i in range(5)] and (table == table[0]).all()


def test_training_against_plain_steps():
    rng = random.Random(1)
    texts = [" ".join(rng.choices(["up", "on"] if i % 2 else ["down", "off", "on"], k=6)) for i in range(12)]
    labels = np.array([i % 2 for i in range(12)])
    bags = [quality.bag(found) for found in quality.buckets(texts, 5)]
    model = quality.train(bags, labels, size=3, epochs=2, rate=2.0, seed=4, bits=5)
    draw = np.random.default_rng(4)
    vectors = draw.uniform(-1 / 3, 1 / 3, (quality.KINDS << 5, 3)).tolist()
    layer = draw.uniform(-1 / 3, 1 / 3, (3, 2)).tolist()
    orders = [draw.permutation(12).tolist() for _ in range(2)]
    plain = [list(zip(b.tolist(), w.tolist(), strict=True)) for b, w in bags]
    wanted = plainly.gradient_steps(plain, labels.tolist(), vectors, layer, np.log([0.5, 0.5]).tolist(), orders, 2.0)
    for found, own in zip((model.vectors, model.layer, model.offsets), wanted, strict=True):
        assert np.allclose(found, own, atol=1e-4)


def test_word_pairs_are_ordered_and_repetition_is_a_sign():
    def pairs(text):
        (found,) = quality.buckets([text], 16)
        return set(found[(found >> 16) == 1].tolist())

    assert pairs("red sky") != pairs("sky red") and len(pairs("red sky red")) == 2
    assert len(pairs("red red red red")) == 2 and len(pairs("red red red") & pairs("sky sky sky")) == 1
    assert quality.buckets(["red", "red"], 16)[1].tolist() == quality.buckets(["red"], 16)[0].tolist()
