"""Document operators against brute force on small tables."""

import random
import re
import zlib
from collections import Counter

import pytest
from llm_util import ALNUM, CASED, WORD, component_ids, documents, prose, shingles, words
from pyspark.sql import functions as F

from cartwheel.llm import decontaminate, licenses, minhash, packing, pii, quality_rules, stats, vectors


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


EDGES = [(0, None), (1, ""), (2, " \n\t "), (3, "one"), (3, "one"), (4, "One two three"), (None, "a b c d e f"), (5, "é" * 50 + " 😀 ok"),
         (6, "a b c d e f g h " * 9_000)]


# near duplicates

def family(rng, size, words_=120):
    """Texts that differ from one another by a few words each."""
    first = prose(rng, words_, 5_000).split()
    out = []
    for _ in range(size):
        t = list(first)
        for _ in range(rng.randrange(0, 5)):
            t[rng.randrange(len(t))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(t))
    return out


def test_near_duplicates_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)  # many salts and blocks
    rng = random.Random(3)
    texts = family(rng, 60) + family(rng, 10, 12) + [prose(rng, rng.randrange(1, 60)) for _ in range(40)]
    texts += texts[:30] + ["Same Text Here"] * 50 + ["a b", "A B", "a  b "] + ["", None, " "]
    order = list(range(len(texts)))
    rng.shuffle(order)
    table = [(i * 7 + 3, texts[k]) for i, k in enumerate(order)]
    want = component_ids(table)
    got = rows(minhash.near_duplicates(documents(spark, table, clash=True)), "doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted((i, len(shingles(t)), want[i], want[i] == i) for i, t in table)
    left = minhash.deduplicate(documents(spark, table))
    assert sorted(r.doc_id for r in left.collect()) == sorted({*want.values()})
    assert left.columns == documents(spark, table).columns


def test_repeated_ids_lose_copies_but_no_unique_text(spark):
    docs = [(1, "one two three four five six"), (1, "one two three four five six"), (1, "One  two three four five six"), (1, ""), (1, ""),
            (2, "one two three four five six"), (2, "a text of its own that no other row has"), (2, " "), (2, ""), (3, "x y z"), (None, "n"), (None, "n")]
    left = minhash.deduplicate(documents(spark, docs, clash=True))
    got = Counter((r.doc_id, (r.text or "").lower().replace("  ", " ")) for r in left.collect())
    assert got == {(1, docs[0][1]): 1, (1, ""): 1, (2, docs[6][1]): 1, (2, " "): 1, (2, ""): 1, (3, "x y z"): 1, (None, "n"): 2}
    assert left.columns == documents(spark, docs, clash=True).columns


def test_near_duplicates_edges(spark):
    got = {r.doc_id: r for r in minhash.near_duplicates(documents(spark, EDGES)).collect()}
    assert got[None].component_id is None and got[None].kept
    assert [got[i].n_shingles for i in (0, 1, 2, 3)] == [0, 0, 0, 1] and got[6].n_shingles == 8
    assert all(got[i].component_id == i for i in range(7))
    assert minhash.near_duplicates(documents(spark, [])).count() == 0


def test_sketch_fills_every_coordinate_and_estimates_similarity():
    base = [f"w{i}" for i in range(400)]
    texts = [" ".join(base), " ".join(base[:320] + [f"v{i}" for i in range(80)]), "one two three four five six", "x"]
    doc, h = minhash.shingles([t.encode() for t in texts])
    s = minhash.sketch(doc, h, len(texts))
    assert (s != minhash.EMPTY).all()
    a, b = (shingles(t) for t in texts[:2])
    true = len(a & b) / len(a | b)
    assert abs((s[0] == s[1]).mean() - true) < 5 * (true * (1 - true) / minhash.T) ** 0.5
    assert (s[0] == s[2]).sum() == 0


def test_sketch_of_a_text_does_not_depend_on_its_batch():
    texts = [t.encode() for t in family(random.Random(5), 6)]
    together = minhash.sketch_rows(texts)["bands"]
    for k, t in enumerate(texts):
        assert (minhash.sketch_rows([t])["bands"][0] == together[k]).all()


# decontamination

def contamination(docs, items, size=10):
    windows = {}
    for i, t in items:
        w = words(t, ALNUM)
        n = min(size, len(w))
        for k in range(len(w) - n + 1) if w else []:
            windows.setdefault(tuple(w[k:k + n]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, found = words(t, ALNUM), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k:k + n])]
        out.append((d, len(w), len(hit), sorted(found), sorted(hit)))
    return out


@pytest.mark.parametrize("limit", [100_000, 0])
def test_decontamination_matches_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", limit)
    rng = random.Random(2)
    items = [(i, prose(rng, 30)) for i in range(6)] + [(6, "short item"), (7, ""), (8, None), (9, "!!!")]
    docs = [(i, prose(rng, 80)) for i in range(20)]
    docs += [(20, "Intro. " + items[0][1].upper() + " -- end"), (21, items[1][1] + " " + items[2][1]), (22, "a SHORT, item here"),
             (23, " ".join(items[3][1].split()[5:17])), (24, "short item " * 30), (25, None), (26, ""), (27, " .- "), (30, items[4][1]), (30, items[4][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = contamination(docs, items)
    got = decontaminate.judge(documents(spark, docs, clash=True), bench).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, sorted(r["items"] or [])) for r in got) == sorted(w[:4] for w in want)
    clean = decontaminate.decontaminate(documents(spark, docs), bench)
    # places are those of the lower-cased words, and what is left keeps its case
    kept = {w[0]: [x for k, x in enumerate(words(t, CASED, False)) if k not in set(w[4])] for w, (_, t) in zip(want, docs)}
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert {i: words(t, CASED, False) for i, t in texts.items()} == kept
    assert texts[20].startswith("Intro. ")
    whole = decontaminate.decontaminate(documents(spark, docs), bench, remove="documents")
    assert sorted({r.doc_id for r in whole.collect()}) == sorted({w[0] for w in want if not w[2]})


def test_decontamination_cuts_by_the_words_of_any_case(spark):
    rng = random.Random(12)
    passage = "Alpha beta GAMMA iPhone delta I saw A new TODO list of eVeRy Kind today"
    clean = ["I", "A", "TODO", "McDonald", "plain", "iPhone", "XyZ", "É", "naïve", "Word", "z9Z"]
    docs, want = [], {}
    for i in range(40):
        before, after = ([rng.choice(clean) for _ in range(rng.randrange(0, 40))] for _ in range(2))
        docs.append((i, " ".join([*before, rng.choice([passage, passage.upper(), passage.lower()]), *after])))
        want[i] = " ".join(before + after)
    docs += [(50, "a SHORT, Item HERE"), (51, "Only I and A"), (52, None)]
    want |= {50: "a HERE", 51: "Only I and A", 52: None}
    bench = spark.createDataFrame([(1, passage), (2, "Short item")], "item_id long, text string")
    done = decontaminate.decontaminate(documents(spark, docs), bench)
    assert {r.doc_id: r.text and r.text.strip() for r in done.collect()} == want
    assert all(r.n_hit == 0 for r in decontaminate.judge(done, bench).collect())


def test_decontamination_without_items_or_rows(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.judge(documents(spark, EDGES), none).collect()
    assert len(got) == len(EDGES) and all(r.n_hit == 0 for r in got)
    assert decontaminate.judge(documents(spark, []), none).count() == 0


# packing

def test_packing_round_trip(spark, monkeypatch):
    from tokenizers import Tokenizer
    import public_tokenizers

    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(4)
    docs = [(i, prose(rng, rng.choice([1, 5, 40, 300, 700, 900, 2000]))) for i in range(120)] + [
        (200, None), (201, ""), (202, "Hello  World'll \n\n 123 é 😀 <|endoftext|>"), (202, "x"), (203, "x"), (203, "x")]
    got = packing.pack(documents(spark, docs, clash=True), with_ids=True).collect()
    texts = sorted(docs, key=lambda d: d[0])
    ids = [reference.encode(t or "", add_special_tokens=False).ids + [0] for _, t in texts]
    by = {}
    for r in got:
        assert r.length == len(r.ids) <= 2048 and zlib.crc32(b"".join(i.to_bytes(4, "little") for i in r.ids)) == r.ids_crc32
        by.setdefault(r.sequence_id, []).append(r)
    for sequence in by.values():
        at = 0
        for r in sorted(sequence, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    single = {i: x for (i, _), x in zip(texts, ids) if sum(j == i for j, _ in texts) == 1}
    for i, want in single.items():
        pieces = sorted((r for r in got if r.doc_id == i), key=lambda r: r.piece)
        assert sum((r.ids for r in pieces), []) == want and [r.start for r in pieces] == [sum(p.length for p in pieces[:k]) for k in range(len(pieces))]
        assert all(p.length == 2048 for p in pieces[1:])
    tokens = sum(map(len, ids))
    room: list[int] = []  # first fit decreasing
    for n in sorted((r.length for r in got), reverse=True):
        k = next((k for k, left in enumerate(room) if left >= n), None)
        if k is None:
            room.append(2048 - n)
        else:
            room[k] -= n
    assert sum(r.length for r in got) == tokens and len(by) <= len(room)


def test_packing_of_long_runs_and_special_strings(spark):
    from tokenizers import Tokenizer
    import public_tokenizers

    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert reference.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    docs = [(1, "a <|endoftext|> b"), (2, "<|endoftext|>" * 3), (3, "x" + " " * 999 + "y" + "\t" * 1500), (4, " " * 3_000_000), (5, "z" + "\n" * 1_000_000 + "z"),
            (6, "q" * 200_000), (7, "<|endoftext|" + " " * 400_000)]
    got: dict[int, list] = {}
    for r in packing.token_pieces(documents(spark, docs), with_ids=True).orderBy("doc_id", "piece").collect():
        got.setdefault(r.doc_id, []).extend(r.ids)
    assert got == {i: [*reference.encode(t, add_special_tokens=False).ids, 0] for i, t in docs}


def test_plan_is_whole_and_two_large_a_bin():
    rng = random.Random(6)
    histogram = Counter(min(2048, max(1, int(rng.lognormvariate(6, 1.2)))) for _ in range(5_000))
    placed, bins = Counter(), {}
    for n, first, ranks, copies, first_bin, offset in packing.plan_bins(dict(histogram)):
        assert first == placed[n]
        placed[n] += ranks
        for k in range(ranks):
            bins.setdefault(first_bin + k // copies, []).append((offset + k % copies * n, n))
    assert placed == histogram
    for items in bins.values():
        at = 0
        for offset, n in sorted(items):
            assert offset == at
            at += n
        assert at <= 2048 and sum(3 * n > 2048 for _, n in items) <= 2
    assert len(bins) <= 1.02 * sum(n * c for n, c in histogram.items()) / 2048 + 1 or sum(3 * n > 2048 for n in histogram)
    assert packing.plan_bins({}) == []


def test_ranks_are_dense_in_salted_lengths(spark):
    pieces = spark.range(500).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"),
                                     (F.col("id") % 3).alias("length"), F.lit(1).cast("long").alias("ids_crc32"))
    got = packing.ranked(pieces, per_task=10).collect()
    for n in range(3):
        own = sorted(r["rank"] for r in got if r["length"] == n)
        assert own == list(range(len(own)))


# personal data

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(text):
    def good(kind, value):
        d = re.sub("[^0-9]", "", value)
        if kind == "ip":
            return all(int(x) <= 255 for x in value.split("."))
        if kind == "card":
            total = sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(d)))
            return 16 <= len(d) <= 19 and total % 10 == 0
        return kind == "email" or 8 <= len(d) <= 15
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if good(k, m.group(0))]


PERSONAL = [
    "mail é😀 bob@x.org, b.c@d.e_f@g.h and a@b.c.d@e.f @x.y a@b", "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 007.08.0.255 1..2.3.4 1.2.3",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111111111111112 411111111111111 9 4111  1111", "+1 (017) 555-7713 +12 +1234567 +(1) 2345678 +1 2+3 45678901",
    "+1.(2)3-4 5.6.7.8) x", "a@b.c" * 40, "1" * 30_000, "a" * 30_000 + "@", "1.2.3." * 5_000, "+1" + " " * 30_000 + "2", "a." * 20_000 + "@b"]


def test_base_spans_match_plain_patterns(spark):
    docs = list(enumerate(PERSONAL)) + [(90, None), (91, ""), (92, "x@y.zz"), (92, "x@y.zz")]
    got = rows(pii.find(documents(spark, docs, clash=True)).select("of", pii.joined(F.col("base")).alias("s")), "of", "s")
    assert got == sorted((i, ",".join(f"{k}:{a}:{b}" for k, a, b in base_spans(t))) for i, t in docs)
    assert pii.find(documents(spark, [])).count() == 0


def test_context_discovers_unseen_identifiers(spark):
    rng = random.Random(8)
    docs = [(i, f"{prose(rng, 20)} reach me at user{i}@mail.example.org {prose(rng, 5)}") for i in range(30)]
    docs += [(100, "please reach me at carol@localhost today"), (101, "pages 1234567 of the book"), (102, "reach me at home"),
             (103, "reach me at <dave77@intranet>, ok")]
    got = {r.of: r.s for r in pii.find(documents(spark, docs)).select("of", pii.joined(F.col("spans")).alias("s")).collect()}
    assert got[100] == "email:19:34" and got[101] == "" and got[102] == "" and got[103] == "email:13:28"
    text = {r.doc_id: r.text for r in pii.redact(documents(spark, docs)).collect()}
    assert text[100] == "please reach me at [EMAIL] today" and text[103] == "reach me at <[EMAIL]>, ok" and text[102] == docs[-2][1]


# licenses

def test_phrases_match_brute_force(spark):
    docs = [(0, "Under the MIT License; under the mit license!"), (1, "the Apache License, Version 2.0"), (2, "cc-by-nc CC BY NC by nc"), (3, None),
            (4, ""), (5, "under the mit licence"), (6, "under the mit license"), (6, "under the mit license"), (7, "x " * 20_000 + "cc by nc"),
            (8, licenses.NOTICES[0][0].replace("free", "completely free")), (9, "permission is hereby given")]
    phrases = {tuple(p.split()): label for p, label in licenses.PHRASES}

    def want(i, t):
        w = words(t, ALNUM)
        at = [(k, label) for p, label in phrases.items() for k in range(len(w)) if tuple(w[k:k + len(p)]) == p]
        starts = [k for k, _ in at]
        return i, len(w), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at}))
    got = licenses.summary(licenses.scan(documents(spark, docs, clash=True), licenses.default_templates(spark))).collect()
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted((want(*d) for d in docs), key=str)
    by = {r.doc_id: r for r in got}
    assert by[8].labels == "mit" and by[8].score < 1 and by[9].labels == "" and by[0].score == 1
    assert licenses.scan(documents(spark, []), licenses.default_templates(spark)).count() == 0


def longest_common(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_common_words_match_brute_force():
    rng = random.Random(5)
    for _ in range(200):
        a, b = ([bytes([rng.randrange(97, 101)]) for _ in range(rng.randrange(90))] for _ in range(2))
        assert licenses.common(a, b) == longest_common(a, b)


@pytest.mark.parametrize("limit", [50_000, 0])
def test_license_spans_are_verified_by_words(spark, monkeypatch, limit):
    monkeypatch.setattr(licenses, "BROADCAST_TEXTS", limit)
    monkeypatch.setattr(licenses, "K", 1)  # single words vote, so that the words' order is left to the check
    notice = "one two three four five six seven eight nine ten"
    templates = spark.createDataFrame([(notice, "some", False), ("alpha beta gamma", "phrase", True), (None, "none", False), ("", "empty", True)],
                                      "text string, label string, phrase boolean")
    docs = [(0, "Intro. " + notice.title() + " -- end"), (1, "two one four three six five eight seven ten nine"),
            (2, "x one two THREE four y five six seven eight nine"), (3, "alpha beta gamma alpha, Beta gamma"), (4, "alpha gamma beta"),
            (None, notice), (5, None), (5, ""), (6, notice), (6, notice), (6, "other text")]
    got = licenses.scan(documents(spark, docs, clash=True), templates).collect()
    spans = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.spans or []]) for r in got), key=str)
    whole = [(0, 10, "some", False, 1.0)]
    assert spans == sorted([
        (0, 12, [(1, 11, "some", False, 1.0)]), (1, 10, []), (2, 11, [(1, 11, "some", False, 0.9)]),
        (3, 6, [(0, 3, "phrase", True, 1.0), (3, 6, "phrase", True, 1.0)]), (4, 3, []), (None, 10, whole), (5, 0, []), (5, 0, []),
        (6, 10, whole), (6, 10, whole), (6, 2, [])], key=str)


def test_license_texts_and_titles(spark):
    texts = {label: text for text, label in licenses.NOTICES}
    docs = [(0, "Copyright 2020\n" + texts["isc"].replace("this software", "the program")), (1, "GNU General Public License, version 3."),
            (2, "the GNU General Public License"), (3, "# " + texts["bsd-3"].replace(" ", "\n# ")), (4, "x " * 30_000 + texts["isc"]),
            (5, texts["cc-by-sa"]), (6, texts["cc-by"]), (7, texts["cc-by"] + ". " + texts["cc-by-sa"]), (8, "Apache License\nVersion 2.0")]
    by = {r.doc_id: r.labels for r in licenses.summary(licenses.scan(documents(spark, docs), licenses.default_templates(spark))).collect()}
    assert by == {0: "isc", 1: "gpl-3", 2: "", 3: "bsd-3", 4: "isc", 5: "cc-by-sa", 6: "cc-by", 7: "cc-by,cc-by-sa", 8: "apache-2"}


# quality rules

def brute_counts(text):
    t = text or ""
    w = WORD.findall(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    c = Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
    covered = {j for k in range(len(w) - 7) if c[tuple(w[k:k + 8])] > 1 for j in range(k, k + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered)


def test_counts_match_brute_force(spark):
    rng = random.Random(9)
    texts = [t for _, t in EDGES] + [prose(rng, 50, 5), "a\n\na\n b\nb\n\n b", "#*$ %&|<> é", "x y\n" * 30]
    for size in (1, len(texts)):
        for k in range(0, len(texts), size):
            some = texts[k:k + size]
            got = stats.base_counts(vectors.Words([(t or "").encode() for t in some], lower=False))
            assert list(zip(*(got[c].tolist() for c in quality_rules.COUNTS))) == [brute_counts(t) for t in some]


def test_steps_of_components_are_few_files(spark):
    """However many partitions a shuffle has, short rows are no file for each."""
    from cartwheel.llm.common import WRITERS
    from cartwheel.llm.components import components
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", "60")
    own.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    chains = own.range(400).selectExpr("id as a", "case when id % 10 = 0 then id else id - 1 end as b")
    found = components(chains)
    assert {(r.node, r.component) for r in found.collect()} == {(k, k - k % 10) for k in range(400) if k % 10}
    assert len(found.inputFiles()) <= WRITERS * own.sparkContext.defaultParallelism
