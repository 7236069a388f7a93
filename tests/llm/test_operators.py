"""Training-data operators against brute force, and on odd rows.

Every operator meets null ids and texts, empty texts, repeated rows, clashing
extra columns and an empty table.
"""

import array
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import FOLDER
from factloom.llm import common, exact_search, fingerprints, mixing, near_duplicates
from factloom.llm import packing, personal_data, quality, token_counts, token_shards, url_filter
from factloom.llm.tokens import CUTS, Encoder, public_path

ODD = [
    (None, "a b", "en", None, 3),
    (3, None, None, "s", 0),
    (3, "", "en", "s", 0),
    (5, "one two three four five six seven", "en", "s", 33),
    (7, "one two three four five six seven", "en", "t", 33),
    (7, "one two three four five six seven", "en", "t", 33),
    (9, "x" * 50_000 + "  \n\n y", "fr", "t", 50_006),
]
#: Extra columns whose names the operators use inside.
EXTRA = "rank", "key", "size", "keep", "spans", "rep", "_n", "uid", "copies"


@pytest.fixture(scope="module")
def odd(spark):
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    extra = ", ".join(f"{c} string" for c in EXTRA)
    rows = [row + ("clash",) * len(EXTRA) for row in ODD]
    return spark.createDataFrame(rows, f"{columns}, {extra}")


@pytest.fixture(scope="module")
def documents(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    return {r["doc_id"]: r for r in rows}


def crc(ids):
    return zlib.crc32(array.array("I", ids).tobytes())


def jaccard(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def words5(text):
    w = text.split()
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) or Counter([tuple(w)] * bool(w))


# --- helpers -----------------------------------------------------------------
def test_blocks_and_ranks(spark):
    rows = spark.range(0, 5000, 7).selectExpr("id - 2000 as k", "id % 3 as g")
    points = common.split_points(rows, "k", 20)
    got = rows.withColumn("b", common.block_of("k", points)).collect()
    assert all(r["b"] == sum(p <= r["k"] for p in points) for r in got)
    ranked = common.numbered(rows, ["g"], ["k"], per_block=50).collect()
    by = defaultdict(list)
    for r in ranked:
        by[r["g"]].append(r["rank"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


@pytest.mark.parametrize("name, cut", [("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")])
def test_units_encode_like_whole_texts(name, cut):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_path(name))
    whole.encode_special_tokens = True
    rng = random.Random(3)
    parts = ["a", "É", "'s", " ", "  ", "\n", "\t", "12", "!?", "\u3000", "\xa0", "\x1c", "\u0301", "ß", "<|endoftext|>", "don't"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    assert CUTS[cut]
    encoder = Encoder(public_path(name), cut, room=50)
    for text, ids in zip(texts, encoder.ids(texts)):
        assert list(array.array("I", ids)) == whole.encode(text, add_special_tokens=False).ids, text


# --- 1 -----------------------------------------------------------------------
def test_fingerprints(spark, documents):
    got = fingerprints.op1_fingerprints(spark, FOLDER).orderBy("doc_id").collect()
    keys = sorted(documents)
    assert [r["doc_id"] for r in got] == keys
    off = []
    for i, r in enumerate(got):
        text, after = documents[keys[i]]["text"], documents[keys[(i + 1) % len(keys)]]["text"]
        n = len(text) // 4
        edited = text[: len(text) - n] + after[:n]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = (Counter(re.split(r"[ \t-\r]+", t)) for t in (text, edited, after))
        off += [jaccard(a, b) - r["near_edited"], jaccard(a, c) - r["near_next"]]
    assert abs(np.mean(off)) < 0.02 and np.abs(off).max() < 0.3
    same = defaultdict(set)
    for k, r in zip(keys, got):
        same[documents[k]["text"]].add(r["fingerprint"])
    assert all(len(v) == 1 for v in same.values())


def test_fingerprints_odd(spark, odd, tmp_path):
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    got = fingerprints.op1_fingerprints(spark, str(tmp_path)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in ODD)
    assert all(r["fingerprint"] == "" for r in got if r["n_chars"] == 0)
    odd.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert fingerprints.op1_fingerprints(spark, f"{tmp_path}/none").collect() == []


# --- 2 -----------------------------------------------------------------------
def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in stopped)
        w = sum(weight[s] for s in names if s not in stopped)
        above = {s for s in names if s not in stopped and left * weight[s] / w > 3 * sizes[s]}
        if not above:
            return {s: 3 * sizes[s] if s in stopped else left * weight[s] / w for s in names}
        stopped |= above


def test_targets_reshare(spark):
    sizes = {"a": 100, "b": 2, "c": 40, "d": 1, "e": 3000, None: 7}
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(rows).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def test_mix(spark, documents):
    got = mixing.op2_mix(spark, FOLDER).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(documents)
    sizes, taken, longest = Counter(), Counter(), Counter()
    for r in got:
        source = documents[r["doc_id"]]["source"]
        size = len(re.findall(r"[^\x20\x09-\x0D]+", documents[r["doc_id"]]["text"]))
        assert r["size"] == size and r["taken"] <= 3 * size and r["taken"] % max(size, 1) == 0
        sizes[source] += size
        taken[source] += r["taken"]
        longest[source] = max(longest[source], size)
    wanted = brute_targets(sizes)
    for r in got:
        assert r["target"] == pytest.approx(wanted[documents[r["doc_id"]]["source"]])
    assert all(abs(taken[s] - wanted[s]) <= longest[s] / 2 for s in wanted)
    again = mixing.op2_mix(spark, FOLDER).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)


def test_mix_odd(odd):
    assert mixing.mix(odd).count() == len(ODD)
    assert mixing.with_copies(odd).columns == odd.columns
    assert mixing.mix(odd.limit(0)).collect() == []


# --- 3 -----------------------------------------------------------------------
def brute_spans(text):
    digits = lambda t: re.sub("[^0-9]", "", t)
    rules = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda t: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda t: all(int(p) <= 255 for p in t.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda t: 12 <= len(digits(t)) <= 19 and personal_data.luhn(digits(t))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: 9 <= len(digits(t)) <= 15),
    ]
    return sorted(
        (m.start(), i, m.end())
        for i, (pattern, valid) in enumerate(rules)
        for m in re.finditer(pattern, text)
        if valid(m[0])
    )


def test_personal_data_patterns():
    rng = random.Random(1)
    for i in range(20_000):
        letters = "ab@..-+%0123459  ()\n1" if i % 2 else "0123456789 -"
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 50)))
        assert personal_data.listed(personal_data.find(text), personal_data.BASE) == brute_spans(text)


def test_personal_data_long_and_further_kinds():
    personal_data.find("a" * 200_000 + "@" + "1" * 200_000 + "+1 " + "(" * 200_000)
    found = personal_data.find("Konto GB82 WEST 1234 5698 7654 32, SSN 123-45-6789, 123-45-6789" + " " * 60 + "123-45-6780")
    assert found["iban"] and len(found["national"]) == 2
    assert personal_data.find("GB82 WEST 1234 5698 7654 33")["iban"] == []


def test_personal_data(spark, documents, odd):
    for r in personal_data.op3_personal_data(spark, FOLDER).collect():
        base = brute_spans(documents[r["doc_id"]]["text"])
        text = ",".join(f"{personal_data.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(r["spans"].split(","))
    masked = personal_data.without_personal_data(odd)
    assert masked.columns == odd.columns and masked.count() == len(ODD)
    assert personal_data.masked("x a@b.c y", personal_data.find("x a@b.c y")) == "x [EMAIL] y"
    assert personal_data.spans(odd.limit(0)).collect() == []


# --- 4 -----------------------------------------------------------------------
def test_token_shards(spark, documents):
    from tokenizers import Tokenizer

    whole, start = Tokenizer.from_file(public_path("byte_bpe_50k.json")), 0
    for r in token_shards.op4_token_shards(spark, FOLDER).orderBy("doc_id").collect():
        ids = whole.encode(documents[r["doc_id"]]["text"], add_special_tokens=False).ids + [0]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), crc(ids))
        start += len(ids)


def test_token_shards_odd(spark, odd):
    path = common.new_path(spark, "odd")
    token_shards.write_shards(odd, path, shard_ids=3)
    rows = token_shards.read_documents(spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [None, 3, 3, 5, 7, 7, 9]
    wanted = spark.createDataFrame([(7,), (4,), (None,), (99,)], "doc_id long")
    found = token_shards.lookup(spark, path, wanted).collect()
    assert Counter(r["doc_id"] for r in found) == {7: 2, None: 1}
    body = {r["doc_id"]: bytes(r["ids"]) for r in rows}
    assert all(bytes(r["ids"]) == body[r["doc_id"]] for r in found)
    none = common.new_path(spark, "none")
    token_shards.write_shards(odd.limit(0), none)
    assert token_shards.read_documents(spark, none).collect() == []


def test_perfect_hash():
    hashes = token_shards.key_hash(np.arange(5000), np.zeros(5000, np.int64))
    index = token_shards.PerfectHash.build(hashes, np.arange(5000) * 3, np.arange(5000))
    index = token_shards.PerfectHash.load(index.dump())
    assert sorted(index.slots(hashes)) == list(range(5000))
    known, offsets, lengths = index.find(hashes)
    assert known.all() and (offsets == np.arange(5000) * 3).all() and (lengths == np.arange(5000)).all()
    foreign = token_shards.key_hash(np.arange(5000, 10_000), np.zeros(5000, np.int64))
    assert not index.find(foreign)[0].any()


# --- 5 (its query has SQL) ----------------------------------------------------
def test_search_odd(spark):
    rows = [
        (20, [1.0, 2.0], "a"),
        (20, [1.0, 2.0], "b"),
        (None, [1.0, 2.0], "c"),
        (1, [float("nan"), 1.0], "d"),
        (2, None, "e"),
        (0, [None, 1.0], "f"),
        (60, [1.0], "g"),
        (3, [], "h"),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    got = sorted(map(tuple, exact_search.search(frame).collect()), key=str)
    score = 64 * 64 + 128 * 128
    assert got == sorted([(20, 1, 20, score), (20, 2, None, score)] * 2, key=str)
    assert exact_search.search(frame.limit(0)).collect() == []


def test_search_pruned_is_exact(spark):
    rng = np.random.default_rng(5)
    body = rng.integers(-3, 4, (700, 24)) / 64 * np.geomspace(40, 1, 24)
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(body)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    found = exact_search.search(frame, k=5, every=50, block=128, step=4).collect()
    whole = np.floor(64 * body.astype(np.float32).astype(np.float64))
    expected = []
    for q in range(0, 700, 50):
        scores = whole @ whole[q]
        order = sorted((-s, i) for i, s in enumerate(scores) if i != q)[:5]
        expected += [(q, r, i, int(-s)) for r, (s, i) in enumerate(order, 1)]
    assert sorted(map(tuple, found)) == expected


# --- 6 -----------------------------------------------------------------------
def brute_classes(texts):
    """Class of every text number by all pairs at a similarity of 0.8."""
    bags, parent = [words5(t) for t in texts], list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if texts[i] == texts[j] or (bags[i] and jaccard(bags[i], bags[j]) >= 0.8):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(texts))]


def test_near_duplicates(spark):
    rng = random.Random(7)
    word = lambda: f"w{rng.randint(0, 400)}"
    texts = []
    for family in range(6):
        base = [word() for _ in range(120)]
        for copy in range(25 if family == 0 else 4):
            changed = list(base)
            for _ in range(copy % 7):
                changed[rng.randrange(120)] = word()
            texts.append(" ".join(changed))
    texts += [texts[0], "short one", "short one", "short two", ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates.near_duplicates(rows).collect()}
    assert [got[i] for i in range(len(texts))] == brute_classes(texts)


def test_units_join_classes():
    base = [f"w{i}" for i in range(100)]
    near = base[:50] + ["z"] + base[51:]
    rows = [[1, 1, " ".join(base)], [2, 2, " ".join(near)], [3, 3, "a b c d e f"], [4, 4, ""]]
    assert near_duplicates._joined(rows) in ([(1, 2)], [(2, 1)])


def test_bag_minhash_is_unbiased():
    rng = np.random.default_rng(0)
    left = {i: int(rng.integers(1, 9)) for i in range(300)}
    right = {i: left.get(i, 0) if i < 200 else int(rng.integers(1, 9)) for i in range(60, 360)}
    true = jaccard(Counter(left), Counter(right))
    keys = np.array([*left, *right], np.uint64)
    counts = np.array([*left.values(), *right.values()])
    owner = np.repeat([0, 1], [len(left), len(right)])
    shares = []
    for seed in range(40):
        hashes = near_duplicates._mix(keys * np.uint64(1_000_003) + np.uint64(seed * 7919))
        one, two = near_duplicates.signatures(2, owner, hashes, counts)
        shares.append((one == two).mean())
    assert abs(np.mean(shares) - true) < 0.03


def test_near_duplicates_odd(odd):
    got = near_duplicates.near_duplicates(odd).collect()
    assert len(got) == len(ODD)
    assert {r["class_id"] for r in got if r["doc_id"] in (5, 7)} == {5}
    kept = near_duplicates.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["3", "5", "9", "None"]
    assert near_duplicates.near_duplicates(odd.limit(0)).collect() == []


# --- 7 -----------------------------------------------------------------------
def test_url_filter(spark):
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    got = url_filter.op7_url_filter(spark, FOLDER).collect()
    assert len(got) == len(urls)
    for r in got:
        found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", urls[r["page_id"]])
        host, path = (found[1].lower(), found[2]) if found else ("", "")
        fits = [
            (len(h + p), h + p, v)
            for v, h, p in url_filter.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        assert (r["host"], r["path"]) == (host, path)
        assert r["rule"] == (max(fits)[1] if fits else None)
        assert r["verdict"] == max(fits)[2] if fits else r["verdict"] in ("allow", "block")


def brute_split(label, counts, total):
    best = None
    for mask in range(1 << (len(label) - 1)):
        words, word = [], ""
        for i, c in enumerate(label):
            word += c
            if i == len(label) - 1 or mask >> i & 1:
                words.append(word)
                word = ""
        p = np.prod([(counts[w] if counts.get(w) else 10.0 ** -len(w)) / total for w in words])
        best = max(best or (0, []), (p, words), key=lambda x: x[0])
    return best[1]


def test_host_words_and_odd_urls(spark):
    counts = {"the": 50, "there": 20, "rein": 5, "in": 30, "re": 4}
    for label in ("therein", "thein", "zzthe", "reinthe"):
        assert url_filter.split_label(label, counts, 200) == brute_split(label, counts, 200)
    rows = [
        (1, None, None, "q"),
        (2, "no scheme", "<p>x</p>", "q"),
        (3, "HTTP://WWW.Free-Casino.ORG", "free casino", "q"),
        (None, "x://A.com/?q", "a", "q"),
        (3, "HTTP://WWW.Free-Casino.ORG", "free casino", "q"),
        (5, "http://b.net/es/", "", "q"),
    ]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, rule string")
    got = url_filter.judged_urls(frame).collect()
    assert sorted((r["host"], r["path"], r["verdict"]) for r in got) == [
        ("", "", "allow"),
        ("", "", "allow"),
        ("a.com", "/", "allow"),
        ("b.net", "/es/", "block"),
        ("www.free-casino.org", "", "block"),
        ("www.free-casino.org", "", "block"),
    ]
    assert url_filter.judged_urls(frame.limit(0)).collect() == []


# --- 8 -----------------------------------------------------------------------
def check_packed(rows, size):
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return len(by)


def test_pack(spark, documents):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_path("word_bpe_49k.json"))
    rows, by, total = packing.op8_pack(spark, FOLDER).collect(), defaultdict(list), 0
    for r in rows:
        by[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for key, doc in documents.items():
        ids = whole.encode(doc["text"], add_special_tokens=False).ids + [1]
        total += len(ids)
        parts = [ids[a : a + 4096] for a in range(0, len(ids), 4096)]
        assert sorted(by[key]) == [(i, 4096 * i, len(p), crc(p)) for i, p in enumerate(parts)]
    assert check_packed(rows, 4096) == -(-total // 4096)


def test_fullest_is_the_fullest():
    rng = random.Random(2)
    for _ in range(200):
        counts = {rng.randint(1, 30): rng.randint(1, 3) for _ in range(5)}
        room, sums = rng.randint(0, 60), {0}
        for length, n in counts.items():
            sums = {s + length * i for s in sums for i in range(n + 1)}
        chosen = packing.fullest(sorted(counts, reverse=True), counts, room)
        assert sum(chosen) == max(s for s in sums if s <= room)
        assert all(n <= counts[k] for k, n in Counter(chosen).items())


def test_pack_odd(odd):
    rows = packing.pack(odd, size=4).collect()
    check_packed(rows, 4)
    assert Counter(r["doc_id"] for r in rows if r["piece"] == 0) == Counter(r[0] for r in ODD)
    assert packing.pack(odd.limit(0)).collect() == []


# --- 9 -----------------------------------------------------------------------
def brute_model(texts):
    """Interpolated modified Kneser-Ney over symbols, gram by gram."""
    found, starts, lengths = quality.symbols(texts)
    grams = Counter()
    for s, n in zip(starts, lengths):
        for i in range(s, s + n):
            grams[tuple(found[i - 3 : i + 1])] += 1
    tables = {4: grams}
    for k in (3, 2, 1):
        tables[k] = Counter(g[1:] for g in tables[k + 1])
    cuts = {k: quality._discounts(Counter(t.values())) for k, t in tables.items()}

    def chance(gram):
        k = len(gram)
        if not k:
            return 1 / quality.SYMBOLS
        seen = {g: n for g, n in tables[k].items() if g[:-1] == gram[:-1]}
        if not seen:
            return chance(gram[1:])
        cut = lambda n: cuts[k][min(n, 3) - 1]
        total, n = sum(seen.values()), seen.get(gram, 0)
        rest = sum(map(cut, seen.values())) / total
        return (n - cut(n) if n else 0) / total + rest * chance(gram[1:])

    return chance


def test_model(spark):
    texts = ["the then. The the", "abab ab\nAb", "", "over there 12"]
    rows = spark.createDataFrame([(i % 2, t) for i, t in enumerate(texts)], "fold int, text string")
    table = quality.train(quality.gram_counts(rows)).table()
    chance, rng = brute_model(texts), np.random.default_rng(1)
    codes = [*quality.grams(texts)[0], *rng.integers(0, 64**4, 50)]
    for code in map(int, codes):
        gram = tuple((code >> shift) & 63 for shift in (18, 12, 6, 0))
        assert table[code] == pytest.approx(-np.log(chance(gram)), rel=1e-4)


def test_repeated_words_are_one_symbol():
    found, starts, lengths = quality.symbols(["no no No no", "no"])
    one = list(found[starts[0] : starts[0] + lengths[0]])
    assert one == [14, 15, quality.REPEAT, quality.REPEAT, quality.REPEAT, 0]
    assert lengths.tolist() == [6, 3]


def test_quality_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    half = labels.filter("doc_id % 2 = 0")
    got = quality.judged(documents, half).join(labels.filter("doc_id % 2 = 1"), "doc_id")
    rows = got.select("quality", "keep").collect()
    good = [r["keep"] for r in rows if r["quality"] == 1]
    bad = [r["keep"] for r in rows if r["quality"] == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.1


def test_quality_odd(spark, odd):
    labels = spark.createDataFrame([(5, 1), (None, 1)], "doc_id long, quality int")
    rows = quality.judged(odd, labels).collect()
    assert len(rows) == len(ODD) and all(r["keep"] for r in rows if r["doc_id"] in (5, 7))
    assert all(r["keep"] for r in quality.judged(odd, labels.limit(0)).collect())
    assert quality.judged(odd.limit(0), labels).collect() == []

def brute_characters(texts):
    """The same model over code points, gram by gram, without Spark."""
    def listed(text):
        words, out, before = re.split(r"(\s+)", text), [], None
        for i, part in enumerate(words):
            if i % 2 == 0 and part and part == before:
                out[-1:] = [quality.AGAIN]
            else:
                out += map(ord, part)
            before = part if i % 2 == 0 and part else before
        return [quality.EDGE] * 3 + out + [quality.EDGE]

    def grams(text):
        found = listed(text)
        return [tuple(found[i - 3 : i + 1]) for i in range(3, len(found))]

    tables = {4: Counter(g for t in texts for g in grams(t))}
    for k in (3, 2, 1):
        tables[k] = Counter(g[1:] for g in tables[k + 1])
    cuts = {k: quality._discounts(Counter(t.values())) for k, t in tables.items()}

    def chance(gram):
        k = len(gram)
        if not k:
            return 1 / quality.EDGE
        seen = [n for g, n in tables[k].items() if g[:-1] == gram[:-1]]
        if not seen:
            return chance(gram[1:])
        cut = lambda n: cuts[k][min(n, 3) - 1] if n else 0
        n = tables[k].get(gram, 0)
        return (n - cut(n) + sum(map(cut, seen)) * chance(gram[1:])) / sum(seen)

    return lambda text: (len(grams(text)), -sum(np.log(chance(g)) for g in grams(text)))


def test_perplexity_by_joins_is_that_of_a_model_by_hand(spark):
    texts = ["the then. The the the end", "привет как дела", "", "abab ab\nAb ab ", "ab 漢字 12 over there 12"]
    rows = [(i, t, "en", i % 2) for i, t in enumerate(texts)] + [(7, "the Ω new", "en", None), (None, None, "ru", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")
    labels = spark.createDataFrame([(i, 1) for i in range(5)], "doc_id long, quality int")
    got = quality.judged(frame.drop("quality"), labels).collect()
    by_hand = brute_characters(texts)
    assert len(got) == len(rows)
    # Each trusted text by the model of the other fold, for the mean of its language.
    folds = dict(frame.selectExpr("doc_id", "pmod(xxhash64(text), 2)").collect())
    assert {folds[i] for i in range(5)} == {0, 1}
    halves = [brute_characters([t for i, t in enumerate(texts) if folds[i] != f]) for f in (0, 1)]
    known = [halves[folds[i]](t) for i, t in enumerate(texts)]
    mean = sum(x for _, x in known) / sum(n for n, _ in known)
    for row in got:
        n, nll = by_hand(row["text"] or "")
        assert row["n_symbols"] == n
        assert row["perplexity"] == pytest.approx(np.exp((nll + 60 * mean) / (n + 60)), rel=1e-9)


def test_garbled_letters_outside_latin_are_other_symbols(spark):
    clean = ["привет как дела сегодня у тебя все хорошо", "今天天气很好我们去公园散步吧"] * 30
    moved = lambda t: "".join(c if c == " " else chr(ord(c) + 3) for c in t)
    rows = [(i, t + f" {i}", "xx") for i, t in enumerate(clean)]
    rows += [(1000 + i, moved(t) * 3, "xx") for i, t in enumerate(clean[:2])]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = frame.filter("doc_id < 1000").selectExpr("doc_id", "1 as quality")
    got = {r["doc_id"]: r["keep"] for r in quality.judged(frame, labels).collect()}
    assert not got[1000] and not got[1001]
    assert sum(got[i] for i in range(60)) >= 57


def test_words_do_not_repeat_across_texts():
    for one in (["no ", " no"], ["a b ", "b a"]):
        alone = [tuple(quality.contexts([t])[0]) for t in one]
        together = quality.contexts(one)
        cuts = np.split(together[0], together[2][1:])
        assert [tuple(c) for c in cuts] == alone


# --- 10 ----------------------------------------------------------------------
def test_section_tokens(spark, documents):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_path("byte_bpe_50k.json"))
    by = defaultdict(list)
    for r in token_counts.op10_section_tokens(spark, FOLDER).collect():
        by[r["doc_id"]].append(r)
    for key, doc in documents.items():
        rows, text = sorted(by[key], key=lambda r: r["section"]), doc["text"]
        assert "".join(text[r["start"] : r["end"]] for r in rows) == text
        counts = [0] * len(rows)
        for a, b in whole.encode(text, add_special_tokens=False).offsets:
            held = [min(b, r["end"]) - max(a, r["start"]) for r in rows]
            counts[held.index(max(held))] += 1
        assert counts == [r["n_tokens"] for r in rows]


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_sections_odd(odd, rule):
    rows = token_counts.section_tokens(odd, rule).collect()
    assert Counter(r["doc_id"] for r in rows if r["section"] == 0) == Counter(r[0] for r in ODD)
    crossing = [r for r in rows if r["doc_id"] == 9]
    assert sum(r["n_crossing"] for r in crossing) in (0, 2)
    assert token_counts.section_tokens(odd.limit(0), rule).collect() == []


def test_allot_rules():
    starts, ends, bounds = np.array([0, 2, 5]), np.array([2, 5, 6]), np.array([0, 3, 6])
    for rule, expected in (("most", [1, 2]), ("start", [2, 1]), ("split", [4 / 3, 5 / 3])):
        counts, touched = token_counts.allot(starts, ends, bounds, rule)
        assert counts.tolist() == pytest.approx(expected) and touched.tolist() == [1, 1]


def test_samples_are_drawn_in_small_aggregations(spark):
    """64 minima in one generated method cost the JVM's compiler gigabytes."""
    rows = spark.createDataFrame([(1, 5, 1.0, 2.0), (1, 6, 2.0, None)], "id long, term long, one double, two double")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        found = fingerprints.samples(rows, ["id"])
        plan = found._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert max(line.count(" min(") for line in plan.splitlines() if "Aggregate" in line) <= 2 * fingerprints.PER_ROW
    got = found.first()
    assert len(got["one"]) == len(got["two"]) == fingerprints.SAMPLES
    for k in (0, 17, 63):
        one = F.expr(f"min({fingerprints.sample_expr('term', 'ln(one)', k)})")
        assert rows.agg(one).first()[0] == got["one"][k]
