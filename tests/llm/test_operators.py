"""The operators against plain versions, on odd tables and on the smallest driver tables."""

import hashlib
import itertools
import json
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioflow.llm import brown, chat, decontaminate, language, ngram_join, packing, quality, secrets, sharding, toxicity
from folioflow.llm.scratch import doc_remainder, with_rank

from . import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def odd(spark):
    return brute.odd(spark).cache()


@pytest.fixture(scope="module")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def key(x):
    return tuple((v is not None, v) for v in x)


# ---------------------------------------------------------------- packing


def sizes_of(made, histogram, capacity):
    filled, count, at = np.zeros(made.sequences, int), np.zeros(capacity + 1, int), {}
    for n, rank, c, first, offset in made.runs:
        assert rank == count[n]
        count[n] += c
        filled[first : first + c] += n
        for s in range(first, first + c):
            at.setdefault(s, []).append((offset, n))
    assert (count == histogram).all() and filled.max(initial=0) <= capacity and (filled > 0).all()
    for parts in at.values():
        end = 0
        for offset, n in sorted(parts):
            assert offset == end
            end += n


@pytest.mark.parametrize("seed", range(12))
def test_plan_places_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.choice([8, 64, 1024]))
    lengths = np.minimum(rng.integers(1, capacity + 1, rng.integers(0, 400)), capacity if seed % 2 else max(1, capacity * 2 // 3))
    histogram = np.bincount(lengths, minlength=capacity + 1)
    made = packing.plan(histogram, capacity)
    sizes_of(made, histogram, capacity)
    total = int((np.arange(capacity + 1) * histogram).sum())
    assert made.sequences <= 1.5 * total / capacity + 2


def test_plan_is_near_the_bound():
    histogram = np.bincount(np.random.default_rng(1).integers(1, 1025, 20_000), minlength=1025)
    made = packing.plan(histogram)
    assert made.sequences <= 1.01 * (np.arange(1025) * histogram).sum() / 1024


def test_grouping_costs_little():
    """Of many lengths several share a group, and are rounded up; the loss against the volume stays below 0.4 %."""
    histogram = np.bincount(np.random.default_rng(1).integers(1, 1024, 2_000_000), minlength=1025)
    assert packing.GROUPS[0] < np.count_nonzero(histogram[int(1024 * packing.SMALL) + 1 : 1024])
    assert packing.plan(histogram).sequences <= 1.004 * (np.arange(1025) * histogram).sum() / 1024


@pytest.mark.parametrize("kind", ["uniform", "log-normal", "large"])
def test_rounding_costs_no_sequence(kind):
    rng = np.random.default_rng(2)
    lengths = {"uniform": rng.integers(1, 1024, 2_000_000), "log-normal": np.clip(rng.lognormal(5.5, 1, 500_000), 1, 1023).astype(int), "large": rng.integers(420, 1000, 1_000_000)}[kind]
    histogram = np.bincount(lengths, minlength=1025)
    began = time.process_time()
    made = packing.best_plan(histogram)
    took = time.process_time() - began
    sizes_of(made, histogram, 1024)
    assert made.sequences <= packing.plan(histogram, groups=1024).sequences <= packing.plan(histogram).sequences * 1.001
    assert took < 15


def ids_of(text):
    from tokenizers import Tokenizer

    if not hasattr(ids_of, "tokenizer"):
        ids_of.tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    return np.array([*ids_of.tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")


@pytest.mark.parametrize("name", ["odd", "docs", "empty"])
def test_packing(request, name):
    df = request.getfixturevalue(name)
    got = packing.pack_documents(df).collect()
    want = []
    for d, t in pairs(df):
        ids = ids_of(t)
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(min(first, len(ids)), len(ids) + 1, 1024)]
        want += [(d, i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=key) == sorted(want, key=key)
    places = {}
    for r in got:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in places.values():
        end = 0
        for offset, n in sorted(parts):
            assert offset == end
            end += n
        assert end <= 1024


def test_sequences_hold_the_ids(spark, odd):
    found = packing.materialize(packing.pieces(odd, with_ids=True), "t")
    whole = packing.sequences(packing.pack(found)).collect()
    assert sum(len(r["ids"]) for r in whole) == sum(len(ids_of(t)) for _, t in pairs(odd))
    assert all(len(r["ids"]) <= 1024 for r in whole)


# ---------------------------------------------------------------- quality


@pytest.mark.parametrize("name", ["odd", "docs", "empty"])
def test_quality(request, name):
    df = request.getfixturevalue(name)
    got = quality.judge(df, ["doc_id", "text", "lang"]).collect()
    assert len(got) == df.count()
    for r in got:
        want = brute.base_metrics(r["text"])
        assert tuple(r[c] for c in quality.METRICS) == want
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r["base_failed"] and r["kept"])


def test_verdicts_as_by_a_plain_model(spark, docs, odd):
    """Bits a byte and verdicts of every text against a model of plain dictionaries."""
    df = docs.filter("n_chars < 2500").select("doc_id", "text", "lang").unionByName(odd.filter("length(text) < 300 or text is null").select("doc_id", "text", "lang"))
    df = spark.createDataFrame(df.collect(), df.schema)
    got = quality.judge(df.withColumn("row", F.monotonically_increasing_id()), ["row", "text", "lang"]).orderBy("row").collect()
    assert any(r["kept"] for r in got) and not all(r["kept"] or r["base_failed"] for r in got)
    for r, (failed, kept, bits) in zip(got, brute.kept_texts([(r["lang"], r["text"]) for r in got]), strict=True):
        assert (r["base_failed"], r["kept"]) == (failed, kept) and r["bits"] == pytest.approx(bits, abs=1e-4)


def test_columns_that_judge_adds_come_first(odd):
    """A column named kept gives way in `judge`, and comes back in `select`."""
    assert dict(quality.judge(odd).dtypes)["kept"] == "boolean" and dict(quality.select(odd.withColumn("kept", F.lit(7))).dtypes)["kept"] == "int"


def test_kneser_ney_sums_to_one():
    rng = random.Random(3)
    text = "".join(rng.choice("aab c") for _ in range(400)).encode()
    chunk = quality.K.Chunk(0, 1, np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    keys, _, _ = quality.running(chunk, *quality.K.spans(chunk, quality.K.WHITE), 3)
    model = quality.KneserNey.fit({"x": quality.K.sum_by(keys, np.ones(len(keys), np.int64))}, 3)
    for context in (b"  ", b" a", b"ab", b"zz"):
        every = np.array([int.from_bytes(context + bytes([c]), "big") for c in range(256)], np.uint64)
        assert np.exp(model.log_p(every, np.zeros(256, np.int64))).sum() == pytest.approx(1, abs=1e-4)


def test_model_takes_every_ngram(spark):
    """What is fetched at once does not change the model, and rare n-grams and small languages stay in it."""
    noise = [(f"{i * 2654435761 % 2**32:08x} {i * 40503 % 2**32:08x} same same", "aa") for i in range(300)]
    df = spark.createDataFrame([*noise, ("sølv blått", "zz")], "text string, lang string")
    counted = quality.count_ngrams(df).count()
    few, all_ = quality.fit(df, quality.ORDER, 10), quality.fit(df)
    assert len(few.grams[-1][0]) == len(all_.grams[-1][0]) == counted and few.langs == all_.langs == {"aa": 0, "zz": 1}
    for a, b in zip([*few.grams, *few.contexts], [*all_.grams, *all_.contexts], strict=True):
        assert all(np.array_equal(x, y) for x, y in zip(a, b, strict=True))


def test_bands_reject_what_is_unlike_its_language(spark):
    rng = random.Random(5)
    say = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(60))
    rows = [(i, say("abcde"), "en") for i in range(300)] + [(i, say("uvxyz"), "en") for i in range(300, 303)]
    got = quality.select(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    kept = {r["doc_id"] for r in got.collect()}
    assert not kept & {300, 301, 302} and len(kept) > 290


# ---------------------------------------------------------------- language


def test_language(spark, docs, odd, empty):
    real = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.identify(real, doc_remainder() == 0, ["doc_id", "lang"]).filter("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)
    found = {r["doc_id"]: r for r in language.identify(odd, doc_remainder() == 0, ["doc_id"]).collect()}
    assert len(found) == odd.select("doc_id").distinct().count()
    assert found[0]["lang_pred"] == found[100]["lang_pred"] == found[13]["lang_pred"] or found[13]["lang_pred"] in ("en", "fr")
    assert {found[i]["lang_pred"] for i in (0, 1, 2, 100)} == {"und"} and found[5]["lang_pred"] in ("en", "fr")
    assert language.identify(empty, doc_remainder() == 0, ["doc_id"]).count() == 0


def test_language_as_by_plain_compression(spark, docs, odd):
    """Dictionaries and answers against zstandard itself."""
    import zstandard

    df = docs.select("doc_id", "text", "lang").unionByName(odd.select("doc_id", "text", "lang"))
    train = df.filter(doc_remainder() != 0).filter("lang is not null and text is not null")
    rows = train.select("lang", "text", F.pmod(F.xxhash64("text"), F.lit(1 << 40)).alias("h")).collect()
    content, often = {}, brute.Counter(r["lang"] for r in rows)
    for lang, _, _, text in sorted({(r["lang"], len(r["text"].encode()) > language.MODERATE, r["h"], r["text"]) for r in rows}):
        more = b" " + language.normal(text)
        if lang not in content or len(content[lang]) + len(more) <= language.DICTIONARY:
            content[lang] = content.get(lang, b"") + more
    names = sorted(content, key=lambda x: (-often[x], x))
    coders = [zstandard.ZstdCompressor(level=language.LEVEL, dict_data=zstandard.ZstdCompressionDict(content[x], dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_checksum=False, write_content_size=False, write_dict_id=False) for x in names]
    for r in language.identify(df, doc_remainder() == 0, ["doc_id", "text"]).collect():
        if r["text"] is None or not any(c.isalpha() for c in r["text"]):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            sizes = [len(c.compress(language.normal(r["text"]))) for c in coders]
            assert r["lang_pred"] == names[sizes.index(min(sizes))]
            assert r["score"] == pytest.approx(1 / sum(2.0 ** (-8 * (x - min(sizes)) / language.SCALE) for x in sizes))


def test_numerals_are_no_letters(spark):
    rows = [(i, t, "en") for i, t in enumerate(["plain words of a language", "½ ²", "Ⅷ ①", "12 34", None, ""], 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(df, F.lit(False), ["doc_id"]).collect()}
    assert got == {1: "en", 2: "und", 3: "und", 4: "und", 5: "und", 6: "und"}


def test_language_of_nearly_all_copies(spark):
    """20,000 rows of 20 texts teach all 20, and those of a language without copies stay 256."""
    copies = spark.range(20_000).select(F.lit("xx").alias("lang"), F.concat(F.lit("zorp"), F.col("id") % 20, F.lit(" "), F.translate((F.col("id") % 20).cast("string"), "0123456789", "abcdefghij")).alias("text"))
    others = spark.range(5_000).select(F.lit("yy").alias("lang"), F.concat(F.lit("word "), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("text"))
    content = dict(language.dictionaries(copies.unionByName(others)))
    assert sorted(set(content["xx"].split()) - {b"zorp"}) == sorted({b"a", b"b", b"c", b"d", b"e", b"f", b"g", b"h", b"i", b"j", *(b"b" + c for c in (b"a", b"b", b"c", b"d", b"e", b"f", b"g", b"h", b"i", b"j"))})
    assert len(content["yy"].replace(b"word ", b"").split()) == language.SAMPLE_TEXTS
    assert list(content) == ["xx", "yy"]


# ---------------------------------------------------------------- sharding


@pytest.mark.parametrize("name", ["odd", "docs", "empty"])
def test_shards(request, name):
    df = request.getfixturevalue(name)
    got = sharding.assign(df.select("doc_id", "text"), 5).collect()
    counts = [sum(r["shard"] == s for r in got) for s in range(5)]
    assert sum(counts) == df.count() and max(counts) - min(counts) <= 1
    for s in range(5):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(counts[s]))
    want = sorted(((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in pairs(df)), key=key)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in got), key=key) == want


@pytest.mark.parametrize(("hot", "groups", "alone", "cut"), [(0, 40, 200, 0), (150, 20, 200, 3), (400, 0, 0, 4), (90, 90, 3, 40)])
def test_copies_share_shards_as_far_as_quotas_allow(spark, hot, groups, alone, cut):
    rows = [(i, "hot") for i in range(hot)] + [(1000 + i, f"g{i % groups}") for i in range(3 * groups)] + [(9000 + i, f"a{i}") for i in range(alone)]
    got = sharding.assign(spark.createDataFrame(rows, "doc_id long, text string"), 5).collect()
    counts = [sum(r["shard"] == s for r in got) for s in range(5)]
    assert max(counts) - min(counts) <= 1
    shards = {}
    for r in got:
        shards.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert sum(len(s) - 1 for s in shards.values()) <= cut


def test_cut_edges(spark):
    bundles = spark.createDataFrame([(1, 0, 3), (1, 1, 2), (2, 0, 4)], "copy_of long, shard int, n long")
    assert tuple(sharding.cut_edges(bundles).first()) == (16, 6)
    assert tuple(sharding.cut_edges(bundles.limit(0)).first()) == (0, 0)


def test_rank_in_chunks(spark):
    df = spark.range(1000).selectExpr("id % 3 as k", "id as v", "id % 7 as w")
    got = with_rank(df, ["k"], ["v"], "r", 8).collect()
    for k in range(3):
        assert sorted(r["r"] for r in got if r["k"] == k) == list(range(sum(r["k"] == k for r in got)))
    sums = sorted((r["r"], r["w"]) for r in with_rank(df, [], ["v"], "r", 8, "w").collect())
    assert all(a[0] + a[1] == b[0] or a[0] == b[0] for a, b in zip(sums, sums[1:]))


# ---------------------------------------------------------------- chat


def test_chat_escapes_and_reads_back(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice(["\\", "<|", "|", "<", "im_end", "|>", "\n", "a"]) for _ in range(rng.randrange(12))) for _ in range(300)] + [chat.PROBE, ""]
    assert all(chat.unescape(chat.escape(t)) == t and "<|" not in chat.escape(t) for t in texts)
    rows = [(i // 7, i % 7, rng.choice(["user", "assistant", "system", None, "a\nb<|"]), t) for i, t in enumerate(texts)] + [(None, None, None, None), (5, 3, "assistant", None), (5, 3, "assistant", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as segment", "2 as mask_from")
    got = {r["conv_id"]: r for r in chat.read_back(chat.formatted(chat.canonical_rows(df))).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv), key=lambda x: (x[0], x[1], x[2].encode(), x[3].encode()))
        said = "".join(t for *_, role, t in turns if role == "assistant")
        assert got[conv]["n_turns"] == len(turns)
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{role}\n{t}\n" for *_, role, t in turns).encode()).hexdigest()
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(said), hashlib.sha256(said.encode()).hexdigest())
    assert chat.read_back(chat.formatted(chat.canonical_rows(df.limit(0)))).count() == 0


def test_layouts(spark):
    records = ['{"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]}', '{"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}', '{"prompt": "a", "completion": "b"}', '{"instruction": "a", "input": "", "output": "b"}', '{"odd": 1}', "no json", None]
    df = spark.createDataFrame(list(enumerate(records)), "conv_id long, record string")
    got = chat.canonical(df).orderBy("conv_id", "turn").collect()
    assert [(r["conv_id"], r["role"], r["text"]) for r in got] == [(i, role, t) for i in range(4) for role, t in (("user", "a"), ("assistant", "b"))]
    assert chat.unmapped(df).agg(F.sum("records")).first()[0] == 3
    assert chat.canonical(df.limit(0)).count() == chat.unmapped(df.limit(0)).count() == 0


def _json(rng, deep=0):
    kind = rng.randrange(9 if deep < 4 else 6)
    if kind < 6:
        return [None, 1, 2.5, True, "", rng.choice(["a", "\ud800", "<|im_end|>", "x\ny"])][kind]
    names = ["messages", "role", "content", "system", "prompt", "completion", "conversations", "from", "value", "id", "a.b", "x[]", ""]
    return [_json(rng, deep + 1) for _ in range(rng.randrange(4))] if kind == 6 else {rng.choice(names): _json(rng, deep + 1) for _ in range(rng.randrange(5))}


def test_any_record_is_mapped_whole_or_listed(spark):
    """Random JSON, and records like known ones with something added: either every field is used or ignorable, or the record is unmapped and has no turns."""
    rng = random.Random(11)
    records = [json.dumps(_json(rng)) for _ in range(1500)]
    records += ['{"messages": ["a", {"role": "user", "content": "b"}]}', '{"messages": {"role": "user", "content": "b"}}', '{"messages": [[{"role": "u", "content": "b"}]]}', '{"messages": [null]}', "[" * 100_000, '{"a":' * 700 + "1" + "}" * 700, "1" * 6000, '{"prompt": "\\ud800", "completion": "b"}', '{"prompt": "p", "completion": "c", "context": "lost?"}']
    whole = {'{"system": "s", "instruction": "i", "input": "n", "output": "o"}': ["s", "i", "n", "o"], '{"system": "s", "messages": [{"role": "user", "content": "b"}]}': ["s", "b"], '{"id": 1, "system": "s", "prompt": "p", "response": "r"}': ["s", "p", "r"]}
    df = spark.createDataFrame(list(enumerate([*records, *whole])), "conv_id long, record string")
    turns = {}
    for r in chat.canonical(df).orderBy("conv_id", "turn").collect():
        turns.setdefault(r["conv_id"], []).append(r["text"])
    known = 0
    for i, record in enumerate([*records, *whole]):
        value = chat._parsed(record)
        mapping = chat.mapping_of(chat.layout(value))
        known += mapping is not None
        assert mapping is not None or i not in turns
        assert mapping is None or all(p in mapping.fields or chat._ignored(p) for p in chat.layout(value))
    assert [turns[len(records) + i] for i in range(len(whole))] == list(whole.values())
    assert chat.unmapped(df).agg(F.sum("records")).first()[0] == len(records) + len(whole) - known


def test_layouts_with_further_fields(spark):
    """Fields of no meaning do not hide a layout, and other names of roles reach the loss mask."""
    records = ['{"id": 7, "meta": {"x": [1]}, "messages": [{"role": "gpt", "content": "b", "weight": 1}]}', '{"source": "s", "prompt": "a", "completion": "b"}']
    got = chat.canonical(spark.createDataFrame(list(enumerate(records)), "conv_id long, record string")).orderBy("conv_id", "turn").collect()
    assert [(r["conv_id"], r["role"], r["text"]) for r in got] == [(0, "assistant", "b"), (1, "user", "a"), (1, "assistant", "b")]
    rows = spark.createDataFrame([(1, 0, "human", "a"), (1, 1, "gpt", "b"), (1, 2, None, None)], "conv_id long, turn long, role string, text string")
    assert [r["role"] for r in chat.canonical_rows(rows).orderBy("turn").collect()] == ["user", "assistant", ""]
    assert [r["role"] for r in chat.canonical_rows(rows, roles={}).orderBy("turn").collect()] == ["human", "gpt", ""]


# ---------------------------------------------------------------- decontamination


@pytest.mark.parametrize("name", ["odd", "docs"])
def test_decontamination(spark, request, name):
    df = request.getfixturevalue(name)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    items += [(900, "One TWO three"), (901, None), (902, "..."), (903, "one two three"), (904, brute.odd_rows()[5][1]), (None, "the cat"), (905, "town")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (10**6, 60):
        got = decontaminate.scan(df, bench, keep=["doc_id", "text"], block_words=block).collect()
        assert len(got) == df.count()
        for r in got:
            want = brute.contamination(r["text"], [x for x in items if x[0] is not None])
            assert (r["n_words"], r["n_hit"], r["items"]) == want


def test_automaton_on_random_words():
    rng = random.Random(11)
    for _ in range(60):
        items = {str(i): np.array([rng.randrange(1, 4) for _ in range(rng.randrange(1, 9))], np.uint64) for i in range(4)}
        a = decontaminate.Automaton(items, 4)
        text = [rng.randrange(1, 5) for _ in range(40)]
        numbers = [int(np.searchsorted(a.vocabulary, t)) if t in a.vocabulary else -1 for t in text]
        spans, found = a.hits(numbers)
        hit, want = {i for s, e in spans for i in range(s, e)}, set()
        plain = set()
        for i, item in items.items():
            v, size = [int(x) for x in item], min(4, len(item))
            for s in range(len(text) - size + 1):
                if any(text[s : s + size] == v[j : j + size] for j in range(len(v) - size + 1)):
                    plain |= set(range(s, s + size))
                    want.add(i)
        assert hit == plain and {a.ids[i] for i in found} == want


def test_items_that_share_an_id_share_an_automaton(spark):
    rng = random.Random(53)
    items = [(1 + i % 2, " ".join(f"w{rng.randrange(30)}" for _ in range(rng.randrange(1, 25)))) for i in range(80)]
    items += items[:10]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert len(list(decontaminate.item_blocks(bench))) == 1
    df = spark.createDataFrame([(i, " ".join(f"w{rng.randrange(30)}" for _ in range(40)) + " " + (items[i % 80][1] if i % 3 else "")) for i in range(60)], "doc_id long, text string")
    for block in (10**6, 60):
        for r in decontaminate.scan(df, bench, block_words=block).collect():
            assert (r["n_words"], r["n_hit"], r["items"]) == brute.contamination(r["text"], items)


def test_clean_cuts_and_drops(spark, empty):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    rows = [(1, "Before. " + item + " and much more text follows here to keep it, word by word by word by word.", "en", "s", 1), (2, item, "en", "s", 1), (3, "clean", None, None, 7), (4, None, None, None, None)]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.clean(spark.createDataFrame(rows, brute.DDL), bench).collect()}
    assert set(got) == {1, 3, 4} and "alpha" not in got[1]["text"] and got[1]["text"].startswith("Before. ") and got[1]["n_chars"] == len(got[1]["text"])
    assert got[3]["n_chars"] == 7
    assert decontaminate.scan(empty, bench).count() == 0


# ---------------------------------------------------------------- toxicity


def test_decoder_restores():
    text = ("the idiot said stupid things and the moron was pathetic trash loser clown scum worthless " * 50).encode()
    s = toxicity._SYMBOL[np.frombuffer(text, np.uint8)]
    counts = np.zeros((28, 28, 28), np.int64)
    np.add.at(counts, (s[:-2], s[1:-1], s[2:]), 1)
    decode = toxicity.Decoder(counts)
    for odd_form, plain in {"st*pid": "stupid", "s.t.u.p.i.d": "stupid", "m0r0n": "moron", "tr@sh": "trash", "stuuupid": "stupid", "p4th3t1c": "pathetic", "1d10t": "idiot", "st" + 60 * "u" + "pid": "stupid", "m" + 500 * "0" + "ron": "moron", "cl0wn": "clown", "loser": "loser"}.items():
        assert decode(odd_form) == plain


def _decoder(text):
    s = toxicity._SYMBOL[np.frombuffer(text.encode(), np.uint8)]
    counts = np.zeros((28, 28, 28), np.int64)
    np.add.at(counts, (s[:-2], s[1:-1], s[2:]), 1)
    return toxicity.Decoder(counts)


def _probability(decode, word, before=(27, 27)):
    (a, b), p = before, 0.0
    for c in [*word, " "]:
        s = 27 if c == " " else decode.symbol(c)
        p, a, b = p + decode.log[a][b][s], b, s
    return p


def test_decoder_finds_the_best_of_all_paths():
    """Every way through the lattice of short words, one by one. Of paths that end in the same last two letters only the last letter enters what may be left out."""
    decode = _decoder("the rain fell on an ass and the moron said trash as the town slept in a cold boat " * 30)
    rng = random.Random(59)
    for word in ["a$$", "a55", "@$$", "m0r0n", "tr@sh", *("".join(rng.choice("aost0$@.") for _ in range(rng.randrange(1, 7))) for _ in range(60))]:
        word = toxicity._RUN.sub(r"\1\1\1", word)
        paths = [("", 0.0)]
        for c in word:
            letter, more = c.isalpha(), []
            for made, cost in paths:
                more.append((made + c, cost + (0.0 if letter else toxicity.COST_SIGN)))
                more += [(made + x, cost + toxicity.COST_RESEMBLES) for x in toxicity.RESEMBLES.get(c, "")]
                last = made[-1:]
                if last and (c == last or last in toxicity.RESEMBLES.get(c, "")):
                    more.append((made, cost + toxicity.COST_REPEAT))
                elif not letter:
                    more.append((made, cost + (toxicity.COST_LOST if c in toxicity.RESEMBLES else toxicity.COST_NOTHING)))
            paths = more
        of = lambda made, cost: _probability(decode, made) - cost
        best = max(of(*x) for x in paths)
        got = decode(word)
        assert max(of(m, c) for m, c in paths if m == got) == pytest.approx(best)
        if len(decode.readings(word)) > 1 and not any(c in ".m" or c.isalpha() for c in word):
            assert len(decode.readings(word)[1]) == len(word)


def test_rows_are_parted_at_the_best_of_all_places():
    decode = _decoder("you are an incomprehensibilities moron and the rain fell on the town of trash " * 40)
    assert decode.parted("youareanincomprehensibilitiesmoron") == ["you", "are", "an", "incomprehensibilities", "moron"]
    assert decode.parted("") == [] and decode.parted("m") == ["m"]
    for row in ("amoron", "rainontown", "oftrash", "xq", "theande"):
        ways = [[row[a:b] for a, b in zip([0, *cut], [*cut, len(row)])] for n in range(len(row)) for cut in itertools.combinations(range(1, len(row)), n)]  # noqa: B905
        got = decode.parted(row)
        assert "".join(got) == row and _probability(decode, " ".join(got)) == pytest.approx(max(_probability(decode, " ".join(w)) for w in ways))


def test_disguises_of_few_letters_and_within_words(spark):
    """Signs for nearly all letters, a blank within a word, and a long word in a spelled row."""
    clean = "the rain fell on the town as the boat came in and the moon rose over hills"
    vile = "incomprehensibilities"
    rng = random.Random(61)
    rows = []
    for i in range(400):
        words = [rng.choice(clean.split()) for _ in range(12)]
        if i % 2:
            words[3:3] = [rng.choice(["ass", "stupid", vile])]
        rows.append((i, " ".join(words), i % 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    odd = {1: "you a$$", 2: "you a55 there", 3: "an @$$ of a man", 4: "how st upid it is", 5: "how st up id it is", 6: "you " + " ".join("areincomprehensibilities"), 7: "pay $100 in 2015", 8: "the as s"}
    got = {r["doc_id"]: r["score"] for r in toxicity.score(spark.createDataFrame([*odd.items(), (9, clean)], "doc_id long, text string"), model, ["doc_id"]).collect()}
    assert all(got[i] > 0.5 for i in (1, 2, 3, 4, 5, 6, 8)) and got[7] == got[9] < 0.5
    restored = {r["doc_id"]: r["restored"] for r in toxicity.restore(spark.createDataFrame(list(odd.items()), "doc_id long, text string"), model.decode, ["doc_id"]).collect()}
    assert restored[7] == odd[7] and restored[1] != odd[1]
    assert model.decode.readings("a$$") == ["as", "ass"] and model.decode.readings("st*pid") == [model.decode("st*pid")]


def test_toxicity(spark, odd, empty):
    real, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.fit(real, labels)
    held = toxicity.score(real.filter(doc_remainder() == 0), model, ["doc_id"]).join(labels, "doc_id").collect()
    y, s = np.array([r["toxic"] for r in held]), np.array([r["score"] for r in held])
    rank = s.argsort().argsort()
    assert (rank[y == 1].mean() - rank[y == 0].mean()) / len(y) + 0.5 > 0.93
    spelled = [(1, "you are an 1d10t and s t u p i d trash loser"), (2, "the rain fell on the town"), (3, "the rain " * 20 + "y o u a r e a n i d i o t a n d a m o r o n"), (4, "a m o r o n"), (5, "a b c d e f g h")]
    spelled = spark.createDataFrame(spelled, "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(spelled, model, ["doc_id"]).collect()}
    assert got[1] > 0.5 > got[2] and got[2] == got[5] < min(got[3], got[4])
    assert {r["doc_id"]: r["restored"] for r in toxicity.restore(spelled, model.decode, ["doc_id"]).collect()}[4] == "amoron"
    joined = toxicity.fit(real.limit(3000), labels, candidates=0)
    sent = toxicity.fit(real.limit(3000), labels)
    assert np.array_equal(joined.features, sent.features) and np.allclose(joined.weights, sent.weights) and len(sent.features)
    scores = toxicity.score(odd, model, ["doc_id"]).collect()
    assert len(scores) == odd.count() and all(0 <= r["score"] <= 1 for r in scores)
    assert toxicity.score(empty, model, ["doc_id"]).count() == 0
    none = toxicity.fit(odd, labels.limit(0))
    assert {r["score"] for r in toxicity.score(odd, none, ["doc_id"]).collect()} == {0.0}
    restored = toxicity.restore(odd, model.decode, ["doc_id", "text"]).collect()
    assert len(restored) == odd.count()


def test_toxicity_as_by_plain_sets(spark):
    """Weights and scores of a small table against sets of words."""
    real, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rng = random.Random(3)
    vile = "grumpf blarg snorkel".split()
    made = [(10**6 + i, " ".join(rng.choice([*"abcdefgh", "town", "rain", "hills", "moon", *(vile if i % 3 == 0 else ["sun"]), "gr*mpf" if i % 3 == 0 else "sun", "b l a r g" if i % 6 == 0 else "sky", "snor kel" if i % 9 == 0 else "sea", "a$$ m 0 o n s n o r k e l i n g b a t t a l i o n s" if i % 12 == 0 else "sand"]) for _ in range(30)), int(i % 3 == 0)) for i in range(120)]
    extra = spark.createDataFrame(made, "doc_id long, text string, toxic int")
    docs = real.filter("n_chars < 3000").select("doc_id", "text").unionByName(extra.select("doc_id", "text"))
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    marks = labels.select("doc_id", "toxic").unionByName(extra.select("doc_id", "toxic"))
    model = toxicity.fit(docs, marks)
    toxic_of = {r["doc_id"]: r["toxic"] for r in marks.collect()}
    both = {r["doc_id"]: brute.toxic_rows(r["text"], model.decode) for r in docs.collect()}
    rows, joined = ({d: x[i] for d, x in both.items()} for i in range(2))
    learn = [d for d in rows if d in toxic_of and brute.remainder(d) not in (0, 4)]
    counts = {True: brute.Counter(), False: brute.Counter()}
    for d in learn:
        counts[toxic_of[d] > 0].update(set().union(*rows[d]))
    n = {x: sum((toxic_of[d] > 0) == x for d in learn) for x in (True, False)}
    weight = {f: np.log((t + 0.5) / (n[True] + 1)) - np.log((counts[False][f] + 0.5) / (n[False] + 1)) for f, t in counts[True].items() if t >= toxicity.LEAST}
    weight = {f: w for f, w in weight.items() if w >= toxicity.STRONG}
    assert len(weight) == len(model.features) > 3 and sorted(weight.values()) == pytest.approx(sorted(model.weights.tolist()))
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model, ["doc_id"]).collect()}
    for d, found in rows.items():
        found = found + joined[d]
        hits = [w for w in (max(weight.get(f, 0.0) for f in r) for r in found) if w > 0]
        x = [max(hits, default=0.0), np.log1p(sum(hits)), np.log1p(len(hits))]
        assert got[d] == pytest.approx(1 / (1 + np.exp(-(model.logistic[0] + np.dot(x, model.logistic[1:])))), abs=1e-9)
    assert len({round(s, 3) for s in got.values()}) > 3


# ---------------------------------------------------------------- secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    t = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(found)


def test_secrets(spark, odd, docs, empty):
    rng = random.Random(13)
    bits = ["token", "=", ": ", '"', "'", " ", "abcdef", "abc", "PassWord", "api_key", "apikey", "AKIA", "A1B2C3D4E5F6G7H8", "deadbeef" * 3, "é", "日", "\n", "secret", ".", "x"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(40))), "en", f"s{i % 3}", 0) for i in range(400)]
    for df in (spark.createDataFrame(rows, brute.DDL), odd, docs, empty):
        got = secrets.spans(df, keep=["doc_id", "text"]).collect()
        assert len(got) == df.count()
        for r in got:
            assert sorted((x["start"], x["kind"], x["end"]) for x in r["found"] if x["kind"] < 3) == base_spans(r["text"])


def test_owners_tell_examples_from_live_secrets(spark):
    shared, own = "token = 'exampleexample1'", "token = 'ownsecret9'"
    rows = [(i, f"see {shared} here", "en", f"s{i}", 1) for i in range(6)] + [(10, f"é {own}, {own} and {shared}", "en", "s0", 1), (11, "gh" + "p_" + "a1B2" * 10, "en", "s1", 1), (12, None, None, None, None)]
    df = spark.createDataFrame(rows, brute.DDL)
    got = {r["doc_id"]: [(x["kind"], x["live"], x["owners"]) for x in r["found"]] for r in secrets.spans(df).collect()}
    assert got[10] == [(0, True, 1), (0, True, 1), (0, False, 6)] and got[11] == [(3, True, 1)] and got[12] == []
    several = [(i, "token = 'zzz999zzz'", "en", f"s{i % 2}", 1) for i in range(30)] + [(100 + i, "token = 'yyy888yyy'", "en", "s0", 1) for i in range(30)]
    verdicts = {(r["doc_id"] >= 100, x["live"]) for r in secrets.spans(spark.createDataFrame(several, brute.DDL)).collect() for x in r["found"]}
    assert verdicts == {(False, False), (True, True)}  # two owners in thirty repositories: an example; one owner in as many: live
    texts = {r["doc_id"]: r for r in secrets.redact(df).collect()}
    assert texts[10]["text"] == f"é [SECRET]', [SECRET]' and {shared}" and texts[10]["n_chars"] == len(texts[10]["text"])
    assert texts[0]["text"] == rows[0][1] and texts[12]["text"] is None and len(texts) == len(rows)


# ---------------------------------------------------------------- n-gram join


@pytest.mark.parametrize("name", ["odd", "docs", "empty"])
def test_near_components(request, name):
    df = request.getfixturevalue(name)
    got = ngram_join.near_components(df).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute.components(pairs(df)), key=key)


def test_near_components_at_the_threshold(spark):
    """Texts of 4 to 80 words, changed by a few, so that many pairs lie at the threshold."""
    rng = random.Random(17)
    rows = []
    for i in range(60):
        words = [f"v{rng.randrange(3000)}" for _ in range(rng.randrange(4, 80))]
        for _ in range(rng.randrange(1, 9)):
            copy = list(words)
            for _ in range(rng.randrange(4)):
                at = rng.randrange(len(copy) + 1)
                copy[at : at + rng.randrange(2)] = [f"n{rng.randrange(9)}"] * rng.randrange(2)
            rows.append((len(rows), " ".join(copy)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = ngram_join.near_components(df).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == sorted(brute.components(rows))


def test_what_a_flush_costs_does_not_grow_with_the_buckets():
    """Some 33 million buckets (about 100 TB of text) still make at most FAN blocks of a flush, and the rounds place every signature in its bucket."""
    rng = np.random.default_rng(47)
    nodes, sizes = rng.integers(-(2**63), 2**63 - 1, 500), rng.integers(3, 99, 500)
    owner = np.repeat(np.arange(500), 100)
    sigs = rng.integers(0, 2**63 - 1, 50_000).astype(np.uint64) * np.uint64(2)
    for buckets in (1, 64, 4096, 4097, 300_000, 1 << 25):
        rounds = ngram_join.fans(buckets)
        every = int(np.prod(rounds))
        assert max(rounds) <= ngram_join.FAN and buckets <= every and (buckets > 4096 or every == buckets)
        b, blocks = ngram_join.pack(nodes, sizes, owner, sigs, every, every // rounds[0])
        assert len(blocks) <= rounds[0] and len(set(b)) == len(b)
        whole = every > rounds[0]
        got = set()
        for bucket, block in zip(b, blocks, strict=True):
            of, n, counts, keys = ngram_join._parts(block, whole)
            got |= set(zip(np.repeat(of, counts).tolist(), np.repeat(n, counts).tolist(), keys.tolist(), strict=True))
            if whole:
                assert ((keys >> np.uint64(32)) % np.uint64(every) // np.uint64(every // rounds[0]) == bucket).all()
        low = sigs if whole else sigs.astype(np.uint32)
        assert got == set(zip(nodes[owner].tolist(), sizes[owner].tolist(), low.tolist(), strict=True))
    assert ngram_join.pack(nodes, sizes, owner[:0], sigs[:0], 64) == ([], [])


def test_near_components_by_several_rounds_of_buckets(spark, monkeypatch):
    """Buckets of 512 signatures, reached by rounds of at most 12: the links of one round."""
    df = spark.createDataFrame(spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(300).select("doc_id", "text").collect())
    want = sorted(map(tuple, ngram_join.near_components(df).select("doc_id", "n_shingles", "component_id").collect()), key=key)
    for name, value in {"BUCKET_SIGS": 1 << 9, "FAN": 12, "FLUSH": 2000, "SPLIT_SIGS": 1 << 10, "HEAVY": 3, "MOST_TASKS": 16}.items():
        monkeypatch.setattr(ngram_join, name, value)
    seen = []
    finer = ngram_join.finer
    monkeypatch.setattr(ngram_join, "finer", lambda *args: seen.append(args[1:]) or finer(*args))
    got = ngram_join.near_components(df).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=key) == want == sorted(brute.components(pairs(df)), key=key) and len(seen) >= 1


def test_what_a_signature_takes_does_not_grow_with_the_corpus():
    """Of 0.1 and 0.5 GB of text it takes the same; of 30 GB there is still one round of buckets, with some 2 M signatures in each."""
    rng = np.random.default_rng(59)
    nodes, sizes = rng.integers(-(2**63), 2**63 - 1, 1400), rng.integers(300, 600, 1400)
    owner, sigs = np.repeat(np.arange(1400), 370), rng.integers(0, 2**63 - 1, 1400 * 370).astype(np.uint64) * np.uint64(2)
    taken = []
    for shingles in (20_000_000, 100_000_000, 6_000_000_000):
        buckets = ngram_join.buckets_of(shingles)
        assert ngram_join.fans(buckets) == [buckets] and shingles / buckets < 2.1 * 2**20
        taken.append(sum(map(len, ngram_join.pack(nodes, sizes, owner, sigs, buckets)[1])) / len(sigs))
    assert taken[0] == taken[1] < 5.6 and taken[2] < 13.5


def test_groups_of_blocks(spark):
    """Nodes that share a signature, each once however many blocks have it; a bucket without a shared one gives nothing."""
    rng = np.random.default_rng(61)
    nodes, sizes = rng.integers(-(2**63), 2**63 - 1, 40), rng.integers(3, 99, 40)
    shared = rng.integers(0, 2**63 - 1, 60).astype(np.uint64)
    rows, met = [(9, bytearray(ngram_join.pack(nodes, sizes, np.arange(40), np.arange(40, dtype=np.uint64), 1)[1][0]), None, None, None)], {}
    for _ in range(3):
        owner = np.sort(rng.integers(0, 40, 120))
        sigs = shared[rng.integers(0, 60, 120)]
        for node, sig in zip(nodes[owner].tolist(), sigs.tolist(), strict=True):
            met.setdefault(sig, set()).add(node)
        rows += [(b, bytearray(x), None, None, None) for b, x in zip(*ngram_join.pack(nodes, sizes, owner, sigs, 5), strict=True)]
    got = {}
    for r in ngram_join.groups(spark.createDataFrame(rows, "bucket int, block binary, gid long, node long, n long")).collect():
        got.setdefault(r["gid"], []).append((r["node"], r["n"], r["size"]))
    size = dict(zip(nodes.tolist(), sizes.tolist(), strict=True))
    want = {tuple(sorted((x, size[x], len(m)) for x in m)) for m in met.values() if len(m) > 1}
    assert {tuple(sorted(x)) for x in got.values()} == want and len(got) == len(want) > 20


def test_a_part_gets_the_sketch_of_a_node_once(spark, monkeypatch):
    """Texts that nearly link share many groups: their sketches are not sent with every one of them, and blocks hold little but hashes."""
    rng = np.random.default_rng(53)
    rows = []
    for c in range(40):
        base = [f"w{c}x{i}" for i in range(150)]
        for _ in range(6):
            words = list(base)
            for at in rng.choice(150, 6, replace=False):
                words[at] = f"y{len(rows)}z{at}"
            rows.append((len(rows), " ".join(words)))
    counted = []
    compared = ngram_join.compared

    def counting(given, *args):
        given = given.cache()
        sent = given.filter("sketch is not null")
        counted.append((given.count(), sent.count()))
        assert given.select("part", "node").distinct().count() == sent.count() == sent.select("part", "node").distinct().count()
        return compared(given, *args)

    monkeypatch.setattr(ngram_join, "compared", counting)
    got = ngram_join.near_components(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == sorted(brute.components(rows))
    assert counted[-1][1] < counted[-1][0] / 2
    sizes = rng.integers(20, 900, 5000)
    owner, sigs = np.repeat(np.arange(5000), 100), rng.integers(0, 2**63 - 1, 500_000).astype(np.uint64)
    _, blocks = ngram_join.pack(rng.integers(-(2**63), 2**63 - 1, 5000), sizes, owner, sigs, 4096)
    assert sum(map(len, blocks)) < 13.5 * len(sigs)  # of 8 and 4 bytes; with plain sizes and numbers it were 20


def test_a_large_group_of_near_copies_gives_out_few_rows(spark, monkeypatch):
    """5,000 near copies of one text, many of their pairs at the threshold: links as by whole sets, and no more than a constant of rows for each row read."""
    rng = np.random.default_rng(41)
    base = [f"w{i}" for i in range(120)]
    rows, kept = [], np.ones((5000, 116), np.float32)
    for i in range(5000):
        words = list(base)
        for at in rng.choice(120, rng.integers(1, 5), replace=False):
            words[at] = f"x{i}y{at}"
            kept[i, max(0, at - 4) : at + 1] = 0
        rows.append((i, " ".join(words)))
    counted = []
    compared = ngram_join.compared

    def counting(given, *args):
        out = compared(given, *args).cache()
        counted.append((given.count(), out.count()))
        return out

    monkeypatch.setattr(ngram_join, "compared", counting)
    got = ngram_join.near_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert counted and all(made <= 4 * read for read, made in counted) and sum(made for _, made in counted) < 5000 * 5000 / 20
    label, shared = np.arange(5000), kept @ kept.T
    linked = 100 * shared >= 75 * (232 - shared)
    np.fill_diagonal(linked, True)
    while True:
        new = np.array([label[x].min() for x in linked])
        if (new == label).all():
            break
        label = new
    assert {r["doc_id"]: r["component_id"] for r in got} == dict(enumerate(label.tolist()))


def test_signatures_leave_one_part_of_a_partition_out():
    rng = random.Random(43)
    a = np.unique(np.array([rng.getrandbits(64) for _ in range(200)], np.uint64))
    (upper, parts, _), *_ = ngram_join.bands(len(a), 75, 100)
    mine, sizes = ngram_join.signatures(a, upper, parts)
    assert len(mine) == ngram_join.SECOND * parts and sizes.sum() == (ngram_join.SECOND - 1) * len(a)
    for i in range(0, 200, 7):  # without one shingle, a partition keeps the subset that leaves its part out
        other, _ = ngram_join.signatures(np.delete(a, i), upper, parts)
        same = (mine == other).reshape(parts, -1).sum(axis=1)
        assert sorted(same.tolist()) == [1, *[ngram_join.SECOND] * (parts - 1)]


def test_linked_sets_share_a_signature():
    rng = random.Random(19)
    none = ngram_join.Hot(np.zeros(0, np.uint64), np.zeros(0, np.int64))
    draw = lambda n: np.unique(np.array([rng.getrandbits(64) for _ in range(n)], np.uint64))
    for n in (3, 4, 5, 7, 9, 12, 15, 16, 17, 20, 31, 33, 48, 64, 65, 100, 200, 400):
        for _ in range(60):
            a = draw(n)
            gone, new = rng.randrange(n // 4 + 1), rng.randrange(n // 3 + 1)
            b = np.unique(np.concatenate([a[rng.sample(range(len(a)), len(a) - gone)] if gone else a, draw(new)])) if new else a[: len(a) - gone]
            shared = len(np.intersect1d(a, b))
            if 100 * shared >= 75 * (len(a) + len(b) - shared) and min(len(a), len(b)) > 2:
                assert np.intersect1d(ngram_join.chosen(a, 75, 100, none), ngram_join.chosen(b, 75, 100, none)).size


@pytest.mark.parametrize("limit", [0, 10**6])
def test_components_by_either_way(spark, limit):
    rng = random.Random(23)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(50)] + [(i, i + 1) for i in range(200, 230)]
    got = {tuple(r) for r in ngram_join.components(spark.createDataFrame(edges, "a long, b long"), len(edges), limit).collect()}
    parent = {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    assert got == {(x, find(x)) for x in parent}


def test_keep_one(spark, odd):
    kept = [r["doc_id"] for r in ngram_join.keep_one(odd).collect()]
    want = [d for d, n, c in {x for x in brute.components(pairs(odd)) if x[0] == x[2] and x[1]}] + [d for d, n, _ in brute.components(pairs(odd)) if not n]
    assert sorted(kept, key=lambda x: (x is not None, x)) == sorted(want, key=lambda x: (x is not None, x))


def test_keep_one_of_rows_that_share_an_id(spark):
    """Row (5, A) is alone in its component and stays, though (5, B) goes."""
    a, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "ac")
    rows = [(3, c), (5, a), (5, c + " more"), (7, a + " a1 a2"), (7, a + " a1 a2"), (9, None), (9, "")]
    kept = ngram_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["text"] or "") for r in kept) == [(3, c), (5, a), (9, ""), (9, "")]


# ---------------------------------------------------------------- language model


@pytest.mark.parametrize("name", ["odd", "docs", "empty"])
@pytest.mark.parametrize("head", [10**6, 40])
def test_brown(request, name, head):
    df = request.getfixturevalue(name)
    got = brown.score_corpus(df, doc_remainder() == 1, head=head, clustered=20, classes=6).collect()
    tokens = [(d, [*brute.words(t), None]) for d, t in pairs(df)]
    counts = brute.Counter(w for d, ws in tokens if brute.remainder(d) != 1 for w in ws)
    n, v = sum(counts.values()), len(counts)
    want = sorted(((d, brute.remainder(d) == 1, len(ws), sum(counts[w] > 0 for w in ws), n, round(sum(np.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 3)) for d, ws in tokens), key=key)
    have = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 3)) for r in got), key=key)
    assert len(have) == len(want)
    for a, b in zip(have, want, strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-5, abs=2e-3)
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_brown_scores_as_by_plain_class_pairs(spark, docs, odd):
    """Scores against counts of class pairs and words in plain dictionaries, for the classes that the exchange made."""
    df = docs.select("doc_id", "text").unionByName(odd.select("doc_id", "text")).withColumn("held_out", doc_remainder() == 1)
    df = spark.createDataFrame(df.collect(), df.schema)
    texts = df.filter("not held_out").select("text")
    brown.ship(spark)
    model, tail = brown.fit(texts, brown.materialize(brown.word_counts(texts), "words"), clustered=20, classes=6)
    classes = {None: model.words.end}

    def class_of(w):
        if w not in classes:
            classes[w] = int(model.words.units_of(next(iter(brown.K.chunks(brown.pa.array([w])))))[1][0])
        return classes[w]

    pairs_, words, types = brute.Counter(), brute.Counter(), brute.defaultdict(set)
    for r in texts.collect():
        before = None
        for w in [*brute.words(r["text"]), None]:
            pairs_[class_of(before), class_of(w)] += 1
            words[w] += 1
            types[class_of(w)].add(w)
            before = w
    size = len(model.emission)
    rows, of_class = brute.Counter(), brute.Counter()
    for (a, b), n in pairs_.items():
        rows[a] += n
        of_class[b] += n
    got = brown.score(df.withColumn("doc_id", F.monotonically_increasing_id()), model, tail).orderBy("doc_id").collect()
    for r, given in zip(got, df.withColumn("i", F.monotonically_increasing_id()).orderBy("i").collect(), strict=True):
        want, before = 0.0, None
        for w in [*brute.words(given["text"]), None]:
            a, b = class_of(before), class_of(w)
            want += np.log10((pairs_[a, b] + 0.5) / (rows[a] + 0.5 * size)) + np.log10((words[w] + 0.5) / (of_class[b] + 0.5 * (len(types[b]) + 1)))
            before = w
        assert r["score"] == pytest.approx(want, rel=1e-6)


def test_exchange_raises_the_likelihood():
    rng = np.random.default_rng(29)
    pairs_ = rng.integers(0, 3, (41, 41))
    pairs_[:20, 20:40] += rng.integers(0, 40, (20, 20))

    def likelihood(of):
        size = of.max() + 1
        joint = np.zeros((size, size))
        np.add.at(joint, (of[:, None], of[None, :]), pairs_)
        x = lambda m: (m * np.log(np.maximum(m, 1))).sum()
        return x(joint) - x(joint.sum(0)) - x(joint.sum(1))

    start = np.concatenate([np.arange(40) % 4, [4]])
    assert likelihood(brown.exchange(pairs_, 40, 4)) > likelihood(start)


def test_brown_beats_the_base_on_held_out_texts(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = [r for r in brown.score_corpus(df, doc_remainder() == 1).collect() if r["held_out"]]
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)


def test_where_a_word_is_held_does_not_enter_its_score(spark, docs):
    """Words of the tail have the classes they would have in the head."""
    far, near = ({r["doc_id"]: r["score"] for r in brown.score_corpus(docs, doc_remainder() == 1, head=head, clustered=20, classes=6).collect()} for head in (200, 10**6))
    assert far.keys() == near.keys() and all(far[d] == pytest.approx(near[d], rel=1e-9) for d in near)


def test_words_beyond_the_seeds_are_exchanged(spark):
    """Rare words of two kinds, told apart by their neighbours alone, join the seeds of their kinds."""
    rng = random.Random(7)
    rows = [(" ".join(f"{'ab'[k]} {'xy'[k]}{rng.choice(['', rng.randrange(200)])}q {'cd'[k]}" for k in [rng.randrange(2) for _ in range(40)]),) for _ in range(60)]
    texts = spark.createDataFrame(rows, "text string")
    brown.ship(spark)
    model, tail = brown.fit(texts, brown.materialize(brown.word_counts(texts), "words"), clustered=6, classes=6)
    of = {}
    for name in {w for (t,) in rows for w in t.split() if w[0] in "xy"}:
        chunk = next(iter(brown.K.chunks(brown.pa.array([name]))))
        of.setdefault(name[0], set()).add(int(model.words.units_of(chunk)[1][0]))
    assert max(of["x"] | of["y"]) < model.words.clustered and not of["x"] & of["y"]
