"""Tokenizers, models, scans and decontamination against brute force, round trips and held-out accuracy."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from sievestone.llm import bpe_trie, decontaminate, fm_toxicity, gru_lm, langid, secret_scan, token_cache
from sievestone.llm.bpe_words import ByteVocabulary
from tokenizers import Tokenizer

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, row long, n long"
PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [None, "", " ", "\n\n  x\t y \n", "a<|endoftext|>b<|endoftext|>", "I'm he'll '' 12ab½ ²", "日本語 При ​ \x1c\x1d", "éèê “q” — €", "\U0001f600\U0001f600", "x" * 5000, "ab " * 20_000, "don't DON'T 'Re"]


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 0, 0.0, 1, 2) for i, t, lang in rows], DOCS)


def odd_docs(spark):
    return docs(spark, [(k, t, None) for k, t in enumerate(ODD)] + [(0, ODD[3], "en"), (None, "null id", None), (None, None, None)])


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(PATH)
    made.no_truncation()
    made.no_padding()
    return made


# Tokens


def test_encoding_digests_of_odd_texts(spark, library):
    made = {r["doc_id"]: r for r in bpe_trie.encoding_digests(odd_docs(spark).where("doc_id > 0"), PATH).collect()}
    for k, t in list(enumerate(ODD))[1:]:
        ids = library.encode(t or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert made[k]["n_tokens"] == len(ids)
        assert made[k]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert made[k]["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_encoded_texts_round_trip(spark, small, library):
    rows = spark.read.parquet(f"{small}/documents.parquet")
    made = {r["doc_id"]: r for r in bpe_trie.encode_texts(rows).collect()}
    for r in rows.collect():
        assert made[r["doc_id"]]["ids"] == library.encode(r["text"], add_special_tokens=False).ids
        assert made[r["doc_id"]]["decoded"] == r["text"]


def test_trie_forgets_within_its_bounds(monkeypatch, library):
    monkeypatch.setattr(bpe_trie, "MAX_NODES", 50)
    monkeypatch.setattr(bpe_trie, "MAX_WORDS", 20)
    monkeypatch.setattr(bpe_trie, "MAX_PAIRS", 30)
    e = bpe_trie.TrieEncoder(ByteVocabulary(PATH))
    rng = random.Random(1)
    for _ in range(20):
        texts = ["".join(rng.choice("abcdeth ing ") for _ in range(80)) for _ in range(5)]
        assert [np.frombuffer(b, "<u4").tolist() for b in e.encode(texts)] == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
        assert [e.decode(b) for b in e.encode(texts)] == texts


def test_token_counts_and_the_cache(spark, library, tmp_path):
    source = odd_docs(spark)
    cache = f"file://{tmp_path}/cache"
    made = token_cache.token_counts(source, cache=cache).collect()
    assert len(made) == source.count()
    for r, s in zip(sorted(made, key=lambda r: (r["doc_id"] is None, r["doc_id"], r["n_bytes"])), sorted(source.collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"], len((r["text"] or "").encode())))):
        n = len(library.encode(s["text"] or "", add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len((s["text"] or "").encode()), n, n > 512)
    stored = spark.read.parquet(cache).count()
    assert stored == len({s["text"] or "" for s in source.collect()})
    more = source.unionByName(docs(spark, [(99, "a new one", None)]))
    token_cache.token_counts(more, cache=cache).count()
    assert spark.read.parquet(cache).count() == stored + 1
    other = token_cache.TokenCache(spark, cache)
    other.version = "another tokenizer"
    assert other.stored().count() == 0


# Language model


def test_base_scores_and_counts(spark):
    rng = random.Random(2)
    words = [f"w{k}" for k in range(40)] + ["ÄB", "Caps", "z" * 100]
    rows = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60))), None) for k in range(120)]
    rows += [(200, None, None), (201, "unseen words only", None), (201, "unseen words only", None), (None, "w1", None), (202, "w1 " * 30_000, None)]
    low = lambda t: [w for w in re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))] + [""]
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
    c = Counter(w for i, t, _ in rows if not held(i) for w in low(t))
    n, v = sum(c.values()), len(c)
    before = gru_lm.HOT
    for hot in (before, 10):
        gru_lm.HOT = hot
        try:
            made = gru_lm.document_log_probs(docs(spark, rows)).collect()
        finally:
            gru_lm.HOT = before
        key = lambda x: (x[0] is None, x[0], x[1])
        got = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["held_out"], r["train_tokens"], r["base_score"]) for r in made), key=key)
        want = sorted(((i, len(low(t)), sum(c[w] > 0 for w in low(t)), held(i), n, sum(math.log10((c[w] + 1) / (n + 1 * (v + 1))) for w in low(t))) for i, t, _ in rows), key=key)
        for a, b in zip(got, want):
            assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9)
        assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in made)


def test_probabilities_sum_to_one():
    model = gru_lm.Gru.start(np.arange(gru_lm.WORDS)[::-1], 500.0)
    states = np.random.default_rng(1).normal(size=(1, gru_lm.HIDDEN)).astype(np.float32)
    words = np.arange(gru_lm.WORDS + 1, dtype=np.int32)  # all words and the tail class
    assert np.exp(model.log_probs(np.repeat(states, len(words), 0), words)).sum() == pytest.approx(1, abs=1e-4)


def test_gradients_are_the_slopes_of_the_loss():
    rng = np.random.default_rng(3)
    model = gru_lm.Gru.start(np.arange(100)[::-1], 5.0)
    for name in gru_lm.NAMES:
        setattr(model, name, getattr(model, name).astype(np.float64))
    ids = [rng.integers(0, 130, 7).astype(np.int32), rng.integers(0, 130, 4).astype(np.int32)]
    ids[0][3] = gru_lm.WORDS
    loss = lambda: -gru_lm.document_scores(model, ids).sum()
    found = {}
    trainer = gru_lm.Trainer(model)
    trainer.apply = lambda words, inputs, grads, total: found.update(grads, words=words, x=inputs)
    trainer.learn(ids)
    by_word = np.zeros_like(model.x)
    np.add.at(by_word, found["words"], found["x"])
    found["x"] = by_word
    for name in gru_lm.NAMES:
        flat, grad = getattr(model, name).reshape(-1), found[name].reshape(-1)
        for k in np.argsort(-np.abs(grad))[:3]:
            was = flat[k]
            flat[k] = was + 1e-4
            up = loss()
            flat[k] = was - 1e-4
            down = loss()
            flat[k] = was
            assert grad[k] == pytest.approx((up - down) / 2e-4, rel=0.02, abs=1e-3)


def test_state_is_carried_across_windows():
    model = gru_lm.Gru.start(np.ones(50), 1.0)
    ids = [np.arange(100, dtype=np.int32) % 50, np.arange(33, dtype=np.int32) % 50, np.zeros(1, np.int32)]
    h, total = np.zeros((1, gru_lm.HIDDEN), np.float32), 0.0
    for w in ids[0]:
        total += model.log_probs(h, np.array([w]))[0]
        h = model.step(h, np.array([w]))[0]
    assert gru_lm.document_scores(model, ids)[0] == pytest.approx(total, rel=1e-4)
    assert np.allclose(gru_lm.document_scores(model, ids, 1), gru_lm.document_scores(model, ids), rtol=1e-4)


def test_model_beats_word_frequencies_on_held_out_text(spark):
    made = gru_lm.document_log_probs(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert made["sum(score)"] > made["sum(base_score)"]


def test_models_are_averaged_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(gru_lm, "FAN_IN", 2)
    monkeypatch.setattr(gru_lm, "TRAINER_TOKENS", 10)
    rows = docs(spark, [(k, f"a b c d{k}", None) for k in range(40)]).repartition(9)
    made = gru_lm.document_log_probs(rows)
    assert made.count() == 40


def test_every_document_trains_once_and_partitions_do_not_matter(spark, monkeypatch):
    seen = []
    average = gru_lm.Gru.from_blob
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    count = lambda df: seen.append({(r["part"], r["seen"]) for r in df.collect()}) or df
    save = gru_lm.common.save
    monkeypatch.setattr(gru_lm.common, "save", lambda df, name: count(save(df, name)) if name == "lm-models" else save(df, name))
    digits = []
    for parts, least in ((1, 10**9), (40, 10**9), (40, 20_000)):
        monkeypatch.setattr(gru_lm, "TRAINER_TOKENS", least)
        seen.clear()
        made = gru_lm.document_log_probs(rows.repartition(parts))
        r = made.where("held_out").selectExpr("-sum(score) / sum(n_tokens) AS digits").first()
        train_tokens = made.first()["train_tokens"]
        assert sum(n for s in seen[: gru_lm.ROUNDS] for _, n in s) == train_tokens
        assert len(seen) == (1 if least > 10**6 else gru_lm.ROUNDS)
        digits.append(r["digits"])
    assert abs(digits[0] - digits[1]) < 0.01
    assert average(gru_lm.Gru.start(np.ones(5), 1.0).blob()).blob() == gru_lm.Gru.start(np.ones(5), 1.0).blob()


def test_the_softmax_of_large_logits():
    states = np.array([[1, -1, 0.5], [0.9, 1, -1]], np.float32)
    weights = np.array([[90, -300, 5, 0], [200, 80, 0, 0], [-9, 7, 0, 300]], np.float32)
    biases = np.array([0, -5, 3, 400], np.float32)
    z = (states @ weights + biases).astype(np.float64)
    for at in range(4):
        expected = z[:, at] - z.max(1) - np.log(np.exp(z - z.max(1, keepdims=True)).sum(1))
        assert np.allclose(gru_lm.log_softmax_at(states, weights, biases, np.full(2, at)), expected, rtol=1e-4, atol=1e-4)
    assert np.allclose(gru_lm.softmax_rows(states, weights, biases).sum(1), 1)


def test_no_documents(spark):
    none = docs(spark, [])
    assert gru_lm.document_log_probs(none).count() == 0
    assert bpe_trie.encoding_digests(none).count() == bpe_trie.encode_texts(none).count() == 0
    assert token_cache.token_counts(none).count() == 0


def test_scores_without_training_documents(spark):
    held_out = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2][:5]
    made = gru_lm.document_log_probs(docs(spark, [(i, "a b", None) for i in held_out])).collect()
    assert {(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in made} == {(3, 0, 0, 0.0)}


# Toxicity


def test_toxicity_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    made = fm_toxicity.toxicity(spark.read.parquet(f"{folder}/documents.parquet"), labels)
    both = made.where("held_out").join(labels, "doc_id").groupBy("predicted", "toxic").count().collect()
    n = {(r["predicted"], r["toxic"]): r["count"] for r in both}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.95
    assert n[1, 1] / (n[1, 1] + n.get((0, 1), 0)) > 0.7


def test_pairs_decide_what_single_terms_do_not():
    rng = np.random.default_rng(1)
    examples, labels = [], []
    for _ in range(1500):
        insult, group = rng.integers(0, 2, 2)
        examples.append(np.unique([*rng.integers(100, 160, 6), *([1] * insult), *([2] * group)]))
        labels.append(int(insult and group))
    model = fm_toxicity.fit(examples, labels)
    assert model.score([1, 2]) > 0.7 > max(model.score([1]), model.score([2]), model.score([]))


def test_scores_equal_all_pairs(spark):
    """The logistic of bias, weights and every pair of vectors, over terms worked out by hand."""
    import xxhash

    rng = np.random.default_rng(2)
    texts = ["Fools and their groups", "the group of fools, fools!", "x", "", None, "fool's-errand 12 ÄRGER ärgerlich", "group"]
    bucket = lambda t: xxhash.xxh32_intdigest(t.encode(), fm_toxicity.SEED) % fm_toxicity.BUCKETS
    sets = []
    for t in texts:
        runs = re.findall(r"[^\W\d_]+", (t or "").lower())
        sets.append({bucket(x) for w in runs for x in [w, *(w[:k] + "-" for k in (3, 4, 5, 6) if k < len(w))]})
    known = sorted(set().union(*sets))[::2]
    model = fm_toxicity.FactorizationMachine(0.3, {b: float(rng.normal()) for b in known}, {b: rng.normal(size=4).astype(np.float32) for b in known})
    made = {r["doc_id"]: r["_score"] for r in fm_toxicity.scores(docs(spark, [(k, t, None) for k, t in enumerate(texts)]), model, "doc_id").collect()}
    for k, s in enumerate(sets):
        own = sorted(s & set(known))
        raw = model.bias + sum(model.weights[b] for b in own) + sum(float(model.vectors[a] @ model.vectors[b]) for n, a in enumerate(own) for b in own[:n])
        assert made[k] == pytest.approx(1 / (1 + math.exp(-raw)), abs=1e-6)


def test_the_training_sample(spark, monkeypatch):
    rows = docs(spark, [(k, f"text {k}", None) for k in range(300)])
    labels = spark.createDataFrame([(k, k % 2 if k % 5 else None) for k in range(280)] + [(4, 1)], "doc_id long, toxic int")
    order = [r["k"] for r in spark.range(300).selectExpr("id AS k", "xxhash64(id) AS h").orderBy("h", "k").collect()]
    fold = [k for k in order if k < 280 and zlib.crc32(str(k).encode()) % 3 != 1 and (k % 5 or k == 4)]
    for bound in (50, 1000):
        made = fm_toxicity.training_sample(rows, labels, bound).collect()
        assert {(r["doc_id"], r["text"], r["toxic"]) for r in made} == {(k, f"text {k}", 1 if k == 4 else k % 2) for k in fold[:bound]}
    seen = []
    monkeypatch.setattr(fm_toxicity, "fit", lambda examples, labels: seen.append((len(examples), sum(map(len, examples)))) or fm_toxicity.FactorizationMachine(0.0, {}, {}))
    fm_toxicity.train(rows, labels)
    monkeypatch.setattr(fm_toxicity, "MAX_TERMS", 50)
    fm_toxicity.train(rows, labels)
    (every, _), (some, terms) = seen
    assert every == len(fold) and 0 < some < every and terms <= 50


def test_toxicity_of_odd_rows(spark):
    labels = spark.createDataFrame([(k, 1, k % 2) for k in range(12)] + [(0, 1, None), (None, 1, 1), (1, 1, 0)], "doc_id long, quality int, toxic int")
    made = fm_toxicity.toxicity(odd_docs(spark), labels).collect()
    assert len(made) == len(ODD) + 3 and all(0 <= r["score"] <= 1 for r in made)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in made if r["doc_id"] is not None)
    none = fm_toxicity.toxicity(odd_docs(spark), labels.where("false")).collect()
    assert {(r["score"], r["predicted"]) for r in none} == {(0.5, 0)}
    kept = fm_toxicity.without_toxic(odd_docs(spark), labels.where("false"))
    assert kept.count() == len(ODD) + 3 and kept.columns == odd_docs(spark).columns
    assert fm_toxicity.toxicity(docs(spark, []), labels).count() == 0


# Language


def test_languages_of_held_out_documents(spark):
    source = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    made = langid.language_report(source).where("held_out").join(source.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in made) / len(made) > 0.98


TEXTS = {"en": "the house and the garden of this old town with all that they have", "de": "der garten und das haus in dieser alten stadt mit allem was sie haben", "ru": "дом и сад в этом старом городе"}


def test_spans_of_a_mixed_text(spark):
    rows = docs(spark, [(k, TEXTS[x], x) for k, x in enumerate(["en", "de", "ru"] * 30)])
    model = langid.train(rows)
    assert model.languages == ["de", "en", "ru"]
    text = f"{TEXTS['en']}. 12 {TEXTS['de']}! {TEXTS['ru']}"
    made = langid.spans(docs(spark, [(1, text, None), (2, None, None)]), model).orderBy("start").collect()
    assert [(r["lang"], text[r["start"] : r["end"]]) for r in made] == [("en", TEXTS["en"]), ("de", TEXTS["de"]), ("ru", TEXTS["ru"])]
    assert {r["doc_id"]: r["n_spans"] for r in langid.languages(docs(spark, [(1, text, None), (2, None, None)]), model).collect()} == {1: 3, 2: 0}


def test_viterbi_equals_brute_force():
    rng = np.random.default_rng(4)
    model = langid.LanguageModel(["a", "b"], np.zeros((2, 1)), np.ones((2, len(langid.NAMES)), bool))
    emit = rng.normal(0, 5, (30, 2)).astype(np.float32)
    ids = [rng.integers(0, 30, n) for n in (9, 9, 4, 1)]
    for path, i in zip(model._viterbi(ids, emit), ids):
        best = max(range(2 ** len(i)), key=lambda m: sum(emit[w, m >> k & 1] for k, w in enumerate(i)) - langid.SWITCH * sum((m >> k & 1) != (m >> k - 1 & 1) for k in range(1, len(i))))
        assert path.tolist() == [best >> k & 1 for k in range(len(i))]


def test_scores_candidates_and_votes_equal_plain_python(spark):
    """Word scores from counts worked out by hand, scripts, the best path by trying all, and the vote by letters."""
    rows = docs(spark, [(k, TEXTS[x], x) for k, x in enumerate(["en", "de", "ru"] * 12)])
    model = langid.train(rows)
    train_ids = [k for k in range(36) if zlib.crc32(str(k).encode()) % 3 != 1]
    grams, scripts = {x: Counter() for x in TEXTS}, {x: Counter() for x in TEXTS}
    buckets = langid.Buckets()
    for k in train_ids:
        x = ["en", "de", "ru"][k % 3]
        for w in TEXTS[x].split():
            grams[x].update(langid.features(w, buckets))
            scripts[x][langid.script(w)] += 1
    total = {x: sum(c.values()) + langid.SMOOTH * langid.BUCKETS for x, c in grams.items()}

    def score(w, x):
        if not scripts[x][langid.script(w)] >= langid.SCRIPT_SHARE * sum(scripts[x].values()) or not scripts[x][langid.script(w)]:
            return -1e6
        own = langid.features(w, buckets)
        return min(len(w), 8) * sum(math.log((grams[x][g] + langid.SMOOTH) / total[x]) for g in own) / len(own)

    names = sorted(TEXTS)
    texts = ["the garden haus", "haus und the old", "дом the haus", "сад дом", "alten stadt this old town"]
    made = {r["doc_id"]: r for r in langid.languages(docs(spark, [(k, t, None) for k, t in enumerate(texts)]), model).collect()}
    for k, t in enumerate(texts):
        words = t.split()
        paths = [[m // 3**n % 3 for n in range(len(words))] for m in range(3 ** len(words))]
        value = lambda p, words=words: sum(score(w, names[x]) for w, x in zip(words, p)) - langid.SWITCH * sum(a != b for a, b in zip(p, p[1:]))
        best = max(paths, key=value)
        letters = Counter()
        for w, x in zip(words, best):
            letters[names[x]] += len(w)
        lang, n = max(letters.items(), key=lambda x: (x[1], -names.index(x[0])))
        assert made[k]["lang_pred"] == lang and made[k]["score"] == pytest.approx(n / sum(letters.values()))
        assert made[k]["n_spans"] == 1 + sum(a != b for a, b in zip(best, best[1:]))


def test_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 2)
    with pytest.raises(ValueError, match="languages"):
        langid.train(docs(spark, [(k, "a b", f"x{k}") for k in range(9)]))


def test_languages_of_odd_rows(spark):
    made = langid.language_report(odd_docs(spark)).collect()
    assert len(made) == len(ODD) + 3 and all(0 <= r["score"] <= 1 for r in made)
    by = {r["doc_id"]: r["lang_pred"] for r in made if r["doc_id"]}
    assert by[1] == by[2] == by[8] == "und"
    assert langid.language_report(docs(spark, [])).count() == 0


# Secrets

PATTERNS = (
    ("assign", re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
)


def expected_secrets(text):
    found = [(m.start(), k, m.end(), name) for k, (name, p, ok) in enumerate(PATTERNS) for m in p.finditer(text or "") if ok(m)]
    spans = ",".join(f"{n}:{s}:{e}" for s, _, e, n in sorted(found))
    return [sum(f[1] == k for f in found) for k in range(3)], hashlib.sha256(spans.encode()).hexdigest()


def secret_texts():
    rng = random.Random(7)
    parts = ["password = hunter22", "TOKEN:abc", "token: secret=abcdefgh", "api_key='ABC/DEF='", "password:token :abcdefgh", "AKIA" + "A" * 16, "AKIAAKIA12", "AKIA" + "9" * 30, "0123456789abcdef" * 2, "abcdef" * 3, "é\U0001f600 ", "deadbeef" * 3 + "x", "secret=", "secret==abcdef", "apikey\": \"q1w2e3r4", "passwd\n:abcdef", "x", "  "]
    return [None, "", *("".join(rng.choice(parts) + rng.choice(["", " ", "\n", "-"]) for _ in range(rng.randint(1, 12))) for _ in range(200)), "secret=abcdef " * 3000]


def test_base_secrets_equal_patterns(spark):
    texts = secret_texts()
    made = {r["doc_id"]: r for r in secret_scan.secrets(docs(spark, [(k, t, None) for k, t in enumerate(texts)])).collect()}
    for k, t in enumerate(texts):
        counts, digest = expected_secrets(t)
        r = made[k]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == counts and r["base_sha256"] == digest
        base = ",".join(s for s in r["spans"].split(",") if s and not s.startswith("random:"))
        assert hashlib.sha256(base.encode()).hexdigest() == digest


def test_random_strings_are_found_and_names_are_not(spark):
    rng = random.Random(11)
    b62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    rows = [(k, f"key {''.join(rng.choice(b62) for _ in range(rng.choice([24, 32, 40])))} end", None) for k in range(100)]
    rows += [(1000 + k, f"file report_of_the_year_{1990 + k % 30}_final_version and 2024-01-{10 + k % 20}-backup-of-the-table", None) for k in range(200)]
    made = {r["doc_id"]: r for r in secret_scan.secrets(docs(spark, rows)).collect()}
    assert sum(made[k]["n_random"] for k in range(100)) >= 85
    assert sum(r["n_random"] for k, r in made.items() if k >= 1000) == 0
    spans = [made[k]["spans"] for k in range(100) if made[k]["n_random"]]
    assert all(re.fullmatch(r"random:4:\d+", s) for s in spans)


def test_short_and_letter_only_random_strings_are_found(spark):
    rng = random.Random(17)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    key = lambda symbols, n: "".join(rng.choice(symbols) for _ in range(n))
    rows = [(k, f"key {key(upper + '234567', 16)} end", None) for k in range(100)]
    rows += [(100 + k, f"key {key(upper + upper.lower(), 40)} end", None) for k in range(100)]
    rows += [(1000 + k, f"the internationalization-of-incomprehensibilities and responsibilities/{'of' * (k % 9)}", None) for k in range(200)]
    made = {r["doc_id"]: r["n_random"] for r in secret_scan.secrets(docs(spark, rows)).collect()}
    assert sum(made[k] for k in range(100)) >= 85
    assert sum(made[k] for k in range(100, 200)) >= 75
    assert sum(n for k, n in made.items() if k >= 1000) == 0


def normal_above(z):
    return 0.5 * math.erfc(z / 2**0.5)


def gamma_above(x, mean, freedom):
    return normal_above(((max(x, 0) / mean) ** (1 / 3) - (1 - 2 / (9 * freedom))) / (2 / (9 * freedom)) ** 0.5)


def expected_p(value):
    """The battery in plain Python: (encoding, p)."""
    body = value.rstrip("=")
    at = next(k for k, e in enumerate(secret_scan.ENCODINGS) if re.fullmatch(f"{e[1]}+", body))
    _, _, natural, frequent = secret_scan.ENCODINGS[at]
    n, k = len(body), len(natural)
    m = max(3, min(k // 2, n // 5))
    m -= m % 2 == 0
    seen = Counter(frequent.index(c) for c in body)
    cells, widths = Counter(), Counter(v * m // k for v in range(k))
    for v, c in seen.items():
        cells[v * m // k] += c
    chi = sum((cells[q] - n * widths[q] / k) ** 2 / (n * widths[q] / k) for q in range(m))
    within = k / n * sum(c * c for c in seen.values()) - n - chi
    ps = [math.exp(-chi / 2) * sum((chi / 2) ** i / math.factorial(i) for i in range((m - 1) // 2)), gamma_above(within, k - m, (k - m) * n / (n - 1))]
    x = [natural.index(c) for c in body]
    high = [2 * v >= k for v in x]
    n1, runs = sum(high), 1 + sum(a != b for a, b in zip(high, high[1:]))
    mu = 2 * n1 * (n - n1) / n + 1
    var = (mu - 1) * (mu - 2) / (n - 1)
    c = [v - sum(x) / n for v in x]
    squares = sum(v * v for v in c)
    serial = sum(a * b for a, b in zip(c, c[1:])) / squares if squares else 0
    zs = [(runs - mu) / var**0.5 if var > 0 else 40, (serial + 1 / n) * n * (n - 1) ** 0.5 / (n - 2) if squares else 40]
    ps += [2 * normal_above(min(abs(z), 8)) for z in zs]
    fisher = sum(-2 * math.log(min(max(p, 1e-12), 1)) for p in ps)
    return at, gamma_above(fisher, 2 * secret_scan.TESTS, secret_scan.FREEDOM)


LENGTHS = (16, 20, 21, 24, 31, 32, 48, 64, 128)


def random_strings(rng, n):
    """n random strings of each encoding, with the encoding that they get."""
    return ["".join(rng.choice(sorted(set(natural))) for _ in range(rng.choice(LENGTHS))) for _, _, natural, _ in secret_scan.ENCODINGS[1:] for _ in range(n)]


def test_the_battery_equals_plain_python_and_is_even(spark):
    rng = random.Random(23)
    values = random_strings(rng, 500)
    odd = ["a" * 16, "ab" * 9, "A" * 40 + "=", "0123456789abcdef" * 4, "0GWm" * 8, "report_of_the_year_1990", "abcdefghijklmnopqrstuvwxyz", "1" * 5000, "AbC+/-_" * 9]
    made = secret_scan.tested(spark.createDataFrame([(k, v) for k, v in enumerate(values + odd)], "k int, value string")).collect()
    by = {}
    for r in made:
        at, p = expected_p(r["value"])
        assert r["encoding"] == at and r["size"] == int(math.log2(len(r["value"].rstrip("="))))
        assert r["p"] == pytest.approx(p, abs=1e-3), r["value"]
        if r["k"] < len(values):
            by.setdefault(at, []).append(r["p"])
        elif r["value"] != "AbC+/-_" * 9:
            assert r["p"] < 0.01, r["value"]
    for at, ps in by.items():
        if len(ps) >= 200:
            for q in (0.1, 0.25, 0.5, 0.75, 0.9):
                assert abs(np.mean(np.array(ps) > q) - (1 - q)) < 0.08, (at, q)


@pytest.mark.parametrize("length", [20, 24, 32, 64])
def test_planted_random_strings_among_documents(spark, length):
    """Recall in each encoding among real texts; letters alone are no keys where long words abound, so lower is left out."""
    rng = random.Random(length)
    source = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    kinds = [e for e in secret_scan.ENCODINGS[1:] if e[0] != "lower"]
    planted, rows = {}, []
    for k, r in enumerate(source):
        text = r["text"] or ""
        if k < 40 * len(kinds):
            name, _, natural, _ = kinds[k % len(kinds)]
            key = "".join(rng.choice(sorted(set(natural))) for _ in range(length))
            planted[r["doc_id"]] = name, len(text) + 1, length
            text = f"{text} {key}"
        rows.append((r["doc_id"], text, None))
    made = {r["doc_id"]: r["spans"] for r in secret_scan.secrets(docs(spark, rows)).collect()}
    found, other = Counter(), 0
    for i, spans in made.items():
        marks = [s.split(":") for s in spans.split(",") if s]
        if i in planted:
            name, start, n = planted[i]
            found[name] += any(int(a) <= start and int(b) >= start + n for _, a, b in marks)
        other += sum(kind == "random" and not (i in planted and int(a) == planted[i][1]) for kind, a, _ in marks)
    total = Counter(x[0] for x in planted.values())
    assert min(total.values()) >= 30
    assert {n: round(found[n] / total[n], 2) for n in total if found[n] < 0.9 * total[n]} == {}
    assert other <= secret_scan.FDR * (other + sum(found.values())), other


def test_added_spans_and_cuts_equal_brute_force(spark):
    rng = random.Random(29)
    words = ["the", "quite", "internationalization", "responsibilities-of-the-house", "secret=hunter22hunter", "f" * 30, "4952935900253052", "0GWm" * 9]
    rows = [(k, " ".join([*rng.sample(words, 5), *([random_strings(rng, 1)[rng.randrange(11)]] if k % 2 else [])]), None) for k in range(400)]
    pattern = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
    tests, counts = [], {}
    for i, t, _ in rows:
        for m in pattern.finditer(t):
            at, p = expected_p(m[0])
            stratum = at, int(math.log2(len(m[0].rstrip("="))))
            counts.setdefault(stratum, [0] * secret_scan.BINS)[min(int(p * secret_scan.BINS), secret_scan.BINS - 1)] += 1
            tests.append((i, m, stratum, p))
    cut = secret_scan.cuts(counts)
    base = {i: [(m.start(), m.end()) for name, pat, ok in PATTERNS for m in pat.finditer(t) if ok(m)] for i, t, _ in rows}
    want = {(i, m.start(), m.end()) for i, m, s, p in tests if s in cut and p >= cut[s] and all(b <= m.start() or a >= m.end() for a, b in base[i])}
    made = {(r["doc_id"], *map(int, s.split(":")[1:])) for r in secret_scan.secrets(docs(spark, rows)).collect() for s in r["spans"].split(",") if s.startswith("random")}
    near = {(i, m.start(), m.end()) for i, m, s, p in tests if s in cut and abs(p - cut[s]) < 1e-3}  # the normal distribution function is an approximation
    assert len(want) > 150 and (made ^ want) <= near


def test_numbers_are_no_letters():
    assert langid.LETTERS.findall("½ ² Ⅻ ab½cd_e1é 一二 x") == ["ab", "cd", "e", "é", "一二", "x"]


def test_secrets_of_no_rows(spark):
    assert secret_scan.secrets(docs(spark, [])).count() == 0


def test_cuts_hold_the_false_share():
    assert secret_scan.cuts({(0, 4): [0] * 50}) == {}
    assert secret_scan.cuts({(0, 4): [10] * 50}) == {(0, 4): 0.0}
    made = secret_scan.cuts({(0, 4): [5000, 50] + [10] * 48})
    assert 0.02 <= made[0, 4] <= 0.06


# Decontamination


def test_window_fingerprints(spark):
    rng = random.Random(5)
    rows = [(k, [rng.getrandbits(64) - (1 << 63) for _ in range(n)]) for k, n in enumerate([1, 2, 3, 30, 31, 400])] + [(6, [-1] * 20_000)]
    made = decontaminate.simhash(spark.createDataFrame(rows, "k int, w array<long>"), "w", "fp").collect()
    for r, (_, w) in zip(sorted(made, key=lambda r: r["k"]), rows):
        assert r["fp"] & (1 << 64) - 1 == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in w) > len(w))


def shingles(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return [" ".join(words[k : k + 5]) for k in range(len(words) - 4)]


def best_windows(rows, items, least=0.8):
    out = {}
    for i, t in rows:
        s = shingles(t)
        for j, u in items:
            b = shingles(u)
            if not b:
                continue
            cb, best = Counter(b), 0
            for k in range(-len(b), len(s)):  # fewer shingles at both ends
                a = Counter(s[max(0, k) : max(0, k + len(b))])
                both = sum((a & cb).values())
                best = max(best, both / (sum(a.values()) + len(b) - both))
            if best >= least:
                out[i, j] = best
    return out


def test_decontamination_equals_all_windows(spark):
    rng = random.Random(13)
    words = [f"w{k}" for k in range(60)]
    text = lambda n: [rng.choice(words) for _ in range(n)]
    items = [(k, " ".join(text(rng.randint(5, 45)))) for k in range(12)] + [(50, "too few words"), (51, None), (52, "same again " * 12)]
    rows = [(200, None), (201, ""), (202, "same again " * 12), (203, "W1 " * 3000)]
    for k in range(60):
        item = items[k % 12][1].split()
        for _ in range(rng.randint(0, 2)):
            item[rng.randrange(len(item))] = "changed"
        if rng.random() < 0.3:
            item.insert(len(item) // 2, "put in")
        cut = rng.random()
        before, after = text(rng.randint(0, 30)), text(rng.randint(0, 30))
        if cut < 0.2:
            item = item[len(item) // 8 :]
        elif cut < 0.4:  # a document that begins inside an item
            item, before = item[len(item) // 8 :], []
        elif cut < 0.6:
            item, after = item[: len(item) - len(item) // 8], []
        rows.append((k, "  ".join(before + item + after).upper()))
    items += [(70, items[3][1].upper()), (71, items[3][1])]  # equal items
    expected = best_windows(rows, items)
    assert len(expected) > 12
    bench = spark.createDataFrame(items, "item_id long, text string")
    source = docs(spark, [(i, t, None) for i, t in rows])
    made = decontaminate.matches(source, bench).collect()
    assert {(r["doc_id"], r["item_id"]): pytest.approx(r["similarity"]) for r in made} == expected
    for name, value in (("BLOCK_ANCHORS", 20), ("BROADCAST_INDEX", 0), ("LANE_ROOM", 0)):  # many passes, an index that is not broadcast, counts of bits apart
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(decontaminate, name, value)
            assert {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(source, bench).collect()} == set(expected)
    kept = decontaminate.without_benchmark(source, bench)
    assert kept.columns == source.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, _ in rows if i not in {d for d, _ in expected})


def test_decontamination_of_nothing(spark):
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontaminate.contamination(docs(spark, []), bench).count() == 0
    assert decontaminate.contamination(odd_docs(spark), bench.where("false")).count() == 0
    assert decontaminate.contamination(odd_docs(spark), bench).count() == 0


# Pipeline


def test_pipeline_equals_its_stages_by_hand(spark, small, library):
    import corpus_pipeline

    source = spark.read.parquet(f"{small}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("labels", "benchmark"))
    rows = {r["doc_id"]: r["text"] or "" for r in source.collect()}
    for r in fm_toxicity.toxicity(source, labels).collect():
        if r["score"] >= 0.7:
            del rows[r["doc_id"]]
    low = lambda s: re.sub("[A-Z]", lambda m: m[0].lower(), s.strip(" \t\n\x0b\x0c\r"))
    count = Counter(k for t in rows.values() for k in {low(s) for s in t.split("\n")})
    rows = {i: "\n".join(s for s in t.split("\n") if not low(s) or count[low(s)] < 10) for i, t in rows.items()}
    from test_dedup import least_of_similar

    rows = {i: rows[i] for i in least_of_similar(rows)}
    leaked = {i for i, _ in best_windows(rows.items(), [(r["item_id"], r["text"]) for r in bench.collect()])}
    rows = {i: t for i, t in rows.items() if i not in leaked}
    made = {r["doc_id"]: r for r in corpus_pipeline.run(spark, small).collect()}
    assert set(made) == set(rows)
    for i, t in rows.items():
        assert made[i]["n_tokens"] == len(library.encode(t, add_special_tokens=False).ids)
        assert made[i]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()


def test_stages_keep_the_columns(spark, small):
    import corpus_pipeline

    source = spark.read.parquet(f"{small}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, source, small).columns == source.columns
        assert stage(spark, source.where("false"), small).count() == 0
