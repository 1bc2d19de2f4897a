"""Texts: encoding against a library's, containers and pieces against what they must hold."""

import itertools
import random
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vintara.llm import bpe, packing
from vintara.llm.encode import token_counts, token_ids
from vintara.llm.packing import pack
from vintara.llm.splitting import split_files, split_texts

tokenizers = pytest.importorskip("tokenizers")
ENC = bpe.encoder()
LIB = tokenizers.Tokenizer.from_file(f"{bpe.TOKENIZERS}/byte_bpe_50k.json")
LIB.encode_special_tokens = True


def want(text):
    return LIB.encode(text or "", add_special_tokens=False).ids


def got(text):
    return np.frombuffer(ENC.encode(text), np.int32).tolist()


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="ab '\n\t\r\x1c\x85\xa0​ éß漢字٣²1.,!-sltdmrve🙂<|endoftext|>", max_size=60)))
def test_any_text_is_encoded_as_by_the_library(text):
    assert got(text) == want(text)


@pytest.mark.parametrize("text", ["", " ", "a", "qz" * 3000, "x7" * 999, " " * 5000 + "end", "\n" * 77, "ab" * 40000 + " tail", "🙂" * 500])
def test_long_and_odd_texts(text):
    assert got(text) == want(text)


def test_memory_is_bounded_and_harmless(monkeypatch):
    monkeypatch.setattr(bpe, "HELD", 5)
    e = bpe.Encoder(f"{bpe.TOKENIZERS}/byte_bpe_50k.tiktoken")
    text = " ".join(f"word{k} Größe" for k in range(50))
    assert np.frombuffer(e.encode(text), np.int32).tolist() == want(text) and len(e.pieces) <= 5 and len(e.words) <= 5


def test_merger_is_the_naive_merge():
    r = random.Random(1)
    for _ in range(300):
        word = bytes(r.choice(b"abcdeinrst ") for _ in range(r.randint(1, 40)))
        parts = [bytes([b]) for b in word]
        while True:
            ranks = [(ENC.ranks.get(a + b, 1 << 40), k) for k, (a, b) in enumerate(zip(parts, parts[1:]))]
            if not ranks or min(ranks)[0] == 1 << 40:
                break
            k = min(ranks)[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        assert ENC.merge(word) == [ENC.ranks[p] for p in parts]


def docs(spark, texts):
    return spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)], "doc_id bigint, text string, key int")


TEXTS = ["", None, "One.\n\nTwo words here.", "A" * 3000, "x " * 4000, *[f"1. The court held in No. {k} that clause {k} binds. It is so ordered.\n\n" * (k % 40 + 1) for k in range(60)], "same", "same"]


def test_ids_and_counts_of_a_table(spark):
    df = docs(spark, TEXTS)
    rows = {r.doc_id: r.ids for r in token_ids(df).collect()}
    assert rows == {k: want(t) for k, t in enumerate(TEXTS)}
    assert {r.doc_id: r.n_tokens for r in token_counts(df).collect()} == {k: len(v) for k, v in rows.items()}
    assert token_ids(df.limit(0)).count() == 0 and token_ids(df.unionByName(df)).count() == 2 * len(TEXTS)


def smallest(sizes, capacity):
    """Fewest containers, by trying all."""
    sizes, best = sorted(sizes, reverse=True), [len(sizes)]

    def go(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(sizes):
            best[0] = len(rooms)
            return
        for r in {*rooms}:
            if r >= sizes[k]:
                left = [*rooms]
                left[left.index(r)] -= sizes[k]
                go(k + 1, left)
        go(k + 1, [*rooms, capacity - sizes[k]])

    go(0, [])
    return best[0]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=11), st.integers(30, 40))
def test_bin_completion_is_valid_and_exact_where_asked(sizes, capacity):
    want = smallest(sizes, capacity)
    for exact in (False, True):
        boxes = packing.bin_completion(sizes, capacity, exact=exact)
        assert sorted(i for b in boxes for i in b) == list(range(len(sizes))) and all(sum(sizes[i] for i in b) <= capacity for b in boxes)
        assert len(boxes) == want if exact else want <= len(boxes) <= len(packing.best_fit(sizes, capacity))
    assert packing.lower_bound(sizes, capacity) <= want


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 12), max_size=8), st.integers(0, 30))
def test_fillings_and_dominance(sizes, room):
    counts = sorted(Counter(sizes).items(), reverse=True)
    got = list(packing.fillings(counts, room))
    every = {tuple(t) for t in itertools.product(*[range(n + 1) for _, n in counts]) if sum(s * k for (s, _), k in zip(counts, t)) <= room}
    told = [tuple(dict(way).get(k, 0) for k in range(len(counts))) for _, way in got]
    assert len(told) == len(every) and {*told} == every
    assert [x for x, _ in got] == sorted((x for x, _ in got), reverse=True)
    for (used, way), t in zip(got, told):
        inside = [counts[k][0] for k, n in way for _ in range(n)]
        out = {s for k, (s, n) in enumerate(counts) if n > t[k]}
        sums = [sub for r in range(len(inside) + 1) for sub in itertools.combinations(inside, r)]
        worse = any(sum(sub) <= x <= sum(sub) + room - used and sub != (x,) for x in out for sub in sums)
        assert packing.undominated(counts, way, room) == (not worse)


def test_a_perfect_packing_is_found():
    assert len(packing.bin_completion([6, 5, 5, 4, 4, 3, 3], 15, exact=True)) == 2  # 6+5+4 and 5+4+3+3


def planted(containers, capacity, seed):
    """Items of full containers: a quarter to a half of each, and a rest."""
    r, out = random.Random(seed), []
    for _ in range(containers):
        a, b = r.randint(capacity // 4, capacity // 2), r.randint(capacity // 4, capacity // 2)
        while capacity - a - b < capacity // 4:
            b = r.randint(capacity // 4, capacity // 2)
        out += [a, b, capacity - a - b]
    r.shuffle(out)
    return out


@pytest.mark.parametrize("containers", [100, 399, 512])
def test_full_groups_are_packed_within_two_percent(spark, containers):
    sizes = planted(containers, 8192, containers)
    items = spark.createDataFrame(list(enumerate(sizes)), "doc_id bigint, n_tokens bigint")
    got = pack(items, 8192).groupBy("container").agg(F.sum("n_tokens").alias("n")).collect()
    alone = len(packing.best_fit(sizes, 8192))
    assert max(x.n for x in got) <= 8192 and sum(x.n for x in got) == sum(sizes)
    assert len(got) <= 1.02 * containers and len(got) < alone, (len(got), alone)


def test_a_filling_of_very_many_items():
    sizes = [1] * 5000 + [7001] * 3 + [2] * 10 + list(range(1, 300))
    boxes = packing.bin_completion(sizes, 60000)
    assert sorted(i for b in boxes for i in b) == list(range(len(sizes))) and all(sum(sizes[i] for i in b) <= 60000 for b in boxes)
    total, way = next(packing.fillings(sorted(Counter(sizes).items(), reverse=True), 50000))
    assert total == 50000 == sum(sorted(Counter(sizes).items(), reverse=True)[k][0] * n for k, n in way)


def test_containers(spark):
    r = random.Random(2)
    sizes = [r.randint(0, 900) for _ in range(1500)] + [1000, 1001, 2500, 3000, 0, None]
    items = spark.createDataFrame([(k if k else None, n) for k, n in enumerate(sizes)], "doc_id bigint, n_tokens bigint").withColumn("part", F.lit(9))
    rows = pack(items, 1000, group=200).collect()
    used, of = Counter(), defaultdict(list)
    for x in rows:
        used[x.container] += x.n_tokens
        of[x.doc_id].append(x)
    assert max(used.values()) <= 1000 and len(of) == len(sizes)
    for k, n in enumerate(sizes):
        mine = sorted(of[k if k else None], key=lambda x: x.part)
        assert sum(x.n_tokens for x in mine) == (n or 0) and [x.begin for x in mine] == [1000 * i for i in range(len(mine))]
        assert len(mine) == max(1, -(-(n or 0) // 1000))
    alone = packing.best_fit([p for n in sizes if n for p in [*[1000] * (n // 1000), n % 1000] if p], 1000)  # all in one group
    assert len(used) <= 1.03 * len(alone)
    assert pack(items.limit(0), 1000).count() == 0
    with pytest.raises(ValueError):
        pack(items, 0)


def letters(n, seed, alphabet="abcdefgh0123XYZ漢"):
    return "".join(random.Random(seed).choice(alphabet) for _ in range(n))


ODD = [
    letters(20000, 4), letters(9000, 5, "qzxjkvwy"), letters(4000, 6, "漢字假名交文章界"), letters(3000, 7, "🙂é"), " " * 9000 + "end", "=" * 5000, "=" * 30000, "a\n" * 5000, "\n\n" + letters(3000, 8, "abcxyz") + " \n \n" + letters(900, 9, "abcxyz") + " end.",
    "!" * 700 + "'s it's" * 400, ("word " * 150 + letters(700, 10, "abcdxyz")) * 6, "Satz eins ist lang genug. " * 900, "x" * 100 + "\t" + letters(5000, 11, "a'sbt!"), "don't \x1c\x85\u2028 stop  here " * 300,
]


@pytest.mark.parametrize("limit,overlap", [(128, 16), (64, 32), (512, 64)])
def test_pieces(spark, limit, overlap):
    texts, by_span = [*TEXTS, *ODD], []
    for span in (3000, 8192, 65536):
        rows = defaultdict(list)
        for x in split_texts(docs(spark, texts), limit, overlap, span=span).collect():
            rows[x.doc_id].append(x)
        by_span.append({k: sorted(map(tuple, v)) for k, v in rows.items()})
    assert by_span[0] == by_span[1] == by_span[2]
    assert set(rows) == {k for k, t in enumerate(texts) if t}
    for k, ps in rows.items():
        t, ps = texts[k], sorted(ps, key=lambda p: p.piece)
        assert [p.piece for p in ps] == list(range(len(ps))) and ps[0].begin == 0 and ps[-1].end == len(t)
        assert (len(ps) == 1) == (len(want(t)) <= limit)
        for p in ps:
            assert p.text == t[p.begin : p.end] and p.n_tokens == len(want(p.text)) <= limit
        for a, b in zip(ps, ps[1:]):
            assert a.begin < b.begin <= a.end < b.end and len(want(t[b.begin : a.end])) >= overlap, (k, a, b)
    natural = Counter(p.cut for k in range(5, 65) for p in rows[k])
    assert set(natural) <= {"paragraph", "item", "sentence", "end"}, natural


def test_pieces_of_files(spark, tmp_path):
    texts = [*ODD, "Größe und Maß. " * 4000, "x"]
    for k, t in enumerate(texts):
        (tmp_path / f"{k} ä.txt").write_bytes(t.encode())
    (tmp_path / "empty.txt").write_bytes(b"")
    got, want_ = defaultdict(list), defaultdict(list)
    for p in split_files(spark, str(tmp_path), 128, 16, span=4096).collect():
        got[int(p.path.rsplit("/")[-1].split("%")[0].split(" ")[0])].append(tuple(p)[1:])
    for p in split_texts(docs(spark, texts), 128, 16).collect():
        want_[p.doc_id].append(tuple(p)[1:])
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want_.items()}


def test_items_and_sentences_within_a_line(spark):
    from vintara.llm import splitting
    from vintara.llm.bpe import encoder

    def natural(text):
        at, _, kinds, _ = splitting.units(text, 0, len(text), 64, encoder("byte_bpe_50k"))
        kinds = splitting.natural(text, splitting.codes_of(text), at, kinds)
        return {text[a:].split()[0] + " " + text[a:].split()[1]: splitting.KINDS[k] for a, k in zip(at.tolist(), kinds.tolist()) if k > splitting.WORD}

    assert natural("It was bad in law. 2. The appeal fails. (b) Costs follow. He did so. It is over now.") == {"2. The": "item", "(b) Costs": "item", "He did": "sentence", "It is": "sentence"}
    assert natural("Vgl. Art. 5 und Nr. 12 des Urt. Smith v. Doe, Az. IV. Senat, Rn. 3 ff. BGB, J. P. Roe am 12. Mai") == {}
    text = " ".join(f"{k}. The court of appeal was right to hold in its ruling of that year that the claim could not be upheld in law." for k in range(1, 80))
    cuts = Counter(p.cut for p in split_texts(docs(spark, [text]), 128, 16).collect())
    assert set(cuts) == {"item", "end"} and cuts["end"] == 1, cuts


def scrambled(n, seed, alphabet):
    r = random.Random(seed)
    return "".join(r.choice(alphabet) for _ in range(n))


def test_a_long_word_is_merged_once(monkeypatch):
    from vintara.llm import splitting

    merged, call = [], bpe.Merger.__call__
    monkeypatch.setattr(bpe.Merger, "__call__", lambda self, word: merged.append(len(word)) or call(self, word))
    for word in (scrambled(9000, 12, "abcdefghXYZ"), scrambled(4000, 13, "漢字假名交文章界")):
        merged.clear()
        planner = splitting.Planner(512, 64, ENC)
        planner.feed(*splitting.units(word, 0, len(word), 64, ENC), True)
        pieces = planner.end(len(word))
        assert len(pieces) > 5 and sum(merged) <= 1.2 * len(word.encode()), (len(pieces), sum(merged))
        assert all(n == len(want(word[a:z])) <= 512 for a, z, n, _ in pieces)
        assert all(a < b and len(want(word[b:z])) >= 64 for (a, z, *_), (b, *_) in zip(pieces, pieces[1:]))


@pytest.mark.parametrize("limit,overlap", [(128, 16), (64, 32), (512, 64)])
def test_pieces_of_scrambled_words_do_not_depend_on_ranges(spark, limit, overlap):
    texts = [
        scrambled(20000, 20, "abcdefghXYZ"), scrambled(9000, 21, "abcXYZ019+/") + " end", scrambled(6000, 22, "漢字假名交文章界"), scrambled(4000, 23, "🙂é漢a"), "=" * 70000 + scrambled(500, 24, "=-"),
        " ".join(scrambled(n, n, "aeinrstÄé") for n in range(60, 900, 37)), "\t" + scrambled(9000, 25, "abcé") + "\n\n" + scrambled(300, 26, "xyz") + " and so on. " * 80,
    ]
    by_span = []
    for span in (3000, 8192, 1 << 17):
        rows = sorted(map(tuple, split_texts(docs(spark, texts), limit, overlap, span=span).collect()))
        by_span.append(rows)
    assert by_span[0] == by_span[1] == by_span[2]
    for k, t in enumerate(texts):
        ps = [p for p in rows if p[0] == k]
        assert ps[0][2] == 0 and ps[-1][3] == len(t) and all(p[6] == t[p[2] : p[3]] and p[4] == len(want(p[6])) <= limit for p in ps)
        assert all(a[2] < b[2] <= a[3] < b[3] and len(want(t[b[2] : a[3]])) >= overlap for a, b in zip(ps, ps[1:]))


def test_ranges_are_made_and_shuffled_once(spark):
    df = split_texts(docs(spark, ["Some words that go on and on. " * 200]), 128, 16, span=2000)
    assert df.collect() and "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["word", "v.", "12.", "Smith.", "end.)", "(b)", "2.", " ", "\n", "\n\n", " \r\n", "The", "a", "x" * 70, "=" * 90, "IV.", "\u2028", "so!", "Größe"]), min_size=3, max_size=60), st.data())
def test_the_last_of_the_most_natural_boundaries(parts, data):
    from vintara.llm import splitting

    text = " ".join(parts)
    at, _, kinds, _ = splitting.units(text, 0, len(text), 64, ENC)
    a = data.draw(st.integers(0, len(at) - 1))
    z = data.draw(st.integers(a + 1, len(at)))
    told = splitting.natural(text, splitting.codes_of(text), at, kinds)[a:z]
    last = len(told) - 1 - int(np.argmax(told[::-1]))
    assert splitting.most_natural(text, splitting.codes_of(text), at, kinds)(a, z) == (last, told[last])


def test_few_bytes_are_merged_as_many(monkeypatch):
    r = random.Random(3)
    words = [bytes(r.choice(b"abcdeinrst =\xc3\xa9") for _ in range(r.randint(0, 95))) for _ in range(300)]
    got_ = [ENC.merge(w) for w in words]
    monkeypatch.setattr(bpe, "FEW", 0)
    assert got_ == [ENC.merge(w) for w in words]


def test_bounds_of_limit_and_overlap(spark):
    for limit, overlap in ((10, 0), (128, 65), (128, -1)):
        with pytest.raises(ValueError):
            split_texts(docs(spark, ["x"]), limit, overlap)


def test_pieces_of_repeated_and_null_keys(spark):
    long = "Some words that go on and on. " * 200
    rows = [(1, "short"), (1, "short"), (1, "other"), (None, long), (None, "x"), (2, long)]
    got = Counter((p.doc_id, p.piece, p.begin) for p in split_texts(spark.createDataFrame(rows, "doc_id bigint, text string"), 128, 16, span=2000).collect())
    assert got[1, 0, 0] == 3 and got[None, 0, 0] == 2 and got[2, 0, 0] == 1
    assert sorted(x[1:] for x in got if x[0] == 2) == sorted(x[1:] for x in got if x[0] is None)
    assert split_texts(spark.createDataFrame([], "doc_id bigint, text string"), 128, 16).count() == 0


def test_core_does_not_need_this_subpackage():
    import subprocess

    code = "import sys; sys.modules['vintara.llm'] = None; import __spark_entry__ as e; assert not any(k.startswith(('p7', 'p8', 'p9')) for k in e.queries())"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=str(__import__("pathlib").Path(__file__).resolve().parents[2]))
