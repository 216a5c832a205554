"""Language identification, language model and URL rules: held-out accuracy and brute force."""

import math
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from playerlens.llm import language, lm, urls
from playerlens.llm.text import LOWER, WordHasher, sample_of

SF = "/root/testdata/sf0.01"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = language.with_language(docs).withColumn("held", language.held_out(F.col("doc_id")))
    right = out.filter("held AND lang IS NOT NULL").select((F.col("lang") == F.col("lang_pred")).cast("int"))
    assert right.groupBy().avg().first()[0] > 0.95
    assert out.filter("NOT score BETWEEN 0 AND 1 OR score IS NULL").count() == 0


def test_languages_of_odd_texts(spark, documents):
    rows = [(1, None), (2, ""), (3, "12 34 !?"), (4, "—…"), (5, "der und die " * 30_000), (5, "der und die"), (None, "the of")]
    docs = documents(rows).withColumn("score", F.lit("mine"))
    made = {"de": language.letters("der die und das ist nicht".encode() * 20), "en": b"the of and to in is " * 20}
    out = language.identify(docs, made).collect()
    assert len(out) == len(rows)
    found = {(r["doc_id"], len(r["text"] or "")): r for r in out}
    for i in (1, 2, 3, 4):
        row = next(r for r in out if r["doc_id"] == i)
        assert (row["lang_pred"], row["score"], row["rejected"]) == ("und", 0.0, True)
    assert found[5, len(rows[4][1])]["lang_pred"] == "de" and not found[5, len(rows[4][1])]["rejected"]
    nothing = language.with_language(documents([(1, "text")]).withColumn("lang", F.lit(None).cast("string")))
    assert [(r["lang_pred"], r["rejected"]) for r in nothing.collect()] == [("und", True)]
    assert language.with_language(documents([])).count() == 0


def test_a_tie_of_a_long_text_is_rejected(spark, documents):
    made = {"a": b"same words", "b": b"same words"}
    rows = language.identify(documents([(1, "same words " * 40), (2, "same")]), made).collect()
    assert [r["rejected"] for r in sorted(rows)] == [True, False]


def test_unlearned_languages_and_gibberish_are_rejected(spark, documents):
    rng = np.random.default_rng(4)
    own = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    long = F.octet_length("text") >= language.MIN_BYTES
    letter = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    odd = [(-i, " ".join(letter(rng.integers(2, 10)) for _ in range(150))) for i in range(1, 41)]
    odd += [(-i, "".join(rng.choice([*"ABCDEFGHIJKLMNOPabcdefghijklmnop0123456789+/"], 800))) for i in range(41, 81)]
    odd = spark.createDataFrame(odd, "doc_id long, text string").withColumn("lang", F.lit(None).cast("string"))
    # French is in the table, but no row of it has a label.
    strange = own.filter((F.col("lang") == "fr") & long).withColumn("lang", F.lit(None).cast("string"))
    learned = own.filter("lang <> 'fr'")
    docs = learned.withColumn("kind", F.lit("clean")).union(odd.withColumn("kind", F.lit("odd")))
    docs = docs.union(strange.withColumn("kind", F.lit("strange")))
    found = language.with_language(docs).filter(long).groupBy("kind").agg(F.avg(F.col("rejected").cast("int")))
    share = dict(found.collect())
    assert share["clean"] < 0.02 and share["odd"] > 0.98 and share["strange"] > 0.9, share


@pytest.mark.parametrize("texts", [3, 60])
def test_copies_do_not_shrink_samples(spark, texts):
    # Few texts in large groups of copies: a share of the rows leaves next to none of them.
    rows = spark.range(texts * 1000).selectExpr(
        f"concat('some text number ', id % {texts}) AS text", f"if(id % {texts} < 2, 'xx', 'yy') AS lang"
    )
    assert sample_of(rows, "text", 20).count() == min(20, texts)
    kept = language.drawn(rows, 20)[0].groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in kept} == {"xx": 2, "yy": min(20, texts - 2)}
    assert set(language.learn(rows, rows_per_language=20)) == {"xx", "yy"}


def words(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW)), None]


def test_language_model_counts_and_base_score(spark, documents):
    rows = [(i, f"The cat {i % 3} sat on the mat\tand  the dog{i} ran") for i in range(40)]
    rows += [(100, None), (101, ""), (102, "zebra zebra unseen"), (None, "the cat"), (5, rows[5][1])]
    held = F.coalesce(F.col("doc_id"), F.lit(0)) >= 100
    docs = documents(rows).withColumn("n_tokens", F.lit("mine"))
    counts = Counter(w for i, t in rows if (i or 0) < 100 for w in words(t))
    total, kinds = sum(counts.values()), len(counts)
    for size in (1 << 20, 64):
        got = lm.score(docs, held, batch_bytes=size).collect()
        assert len(got) == len(rows)
        want = Counter()
        for i, t in rows:
            w = words(t)
            base = math.fsum(math.log10((counts[x] + 1) / (total + kinds + 1)) for x in w)
            want[i, len(w), sum(counts[x] > 0 for x in w), total, round(base, 8)] += 1
        assert want == Counter(
            (r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 8)) for r in got
        )
        assert all(r["score"] < 0 for r in got)


def test_probabilities_of_all_words_sum_to_one(spark, documents):
    rows = [(i, " ".join(f"w{(i * k) % 17}" for k in range(1, 12))) for i in range(60)]
    docs = documents(rows)
    corpus, known = lm.encoded(docs, F.lit(False), classes=6, batch_bytes=1 << 20)
    weights, bias = lm.train(corpus, known, bits=8, rounds=2, step=64, rate=0.3)
    assert np.abs(weights).max() > 0
    counts = Counter(w for _, t in rows for w in words(t))
    hasher = WordHasher(LOWER)
    total = {}
    for w, c in counts.items():
        h = np.array([lm.END], np.uint64) if w is None else hasher.one(w.encode())
        k = int(known.of(np.array([c]), h)[0])
        total[k] = total.get(k, 0) + (c + 1)
    unknown = int(known.of(np.zeros(1, np.int64), np.zeros(1, np.uint64))[0])
    total[unknown] = total.get(unknown, 0) + 1
    assert all(known.mass[k] == m for k, m in total.items()) and known.mass.sum() == sum(total.values())
    p = lm.class_probabilities(weights, bias, lm.feature_rows(np.arange(50, dtype=np.uint16), 8))
    assert np.allclose(p.sum(axis=1), 1)


def test_context_helps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = lm.score(docs, F.col("doc_id") % 7 == 2)
    base, model = rows.filter("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    assert model > base


def test_scores_do_not_depend_on_partitions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")

    def scores(rows, **how):
        got = lm.score(rows, F.col("doc_id") % 7 == 2, **how)
        return sorted((r["doc_id"], r["base_score"], r["score"]) for r in got.collect())

    one = scores(docs.coalesce(1))
    assert len(one) == docs.count()
    assert scores(docs.repartition(13), batch_bytes=20_000) == one
    # Smaller steps add up a text's logarithms in another order, but from the same weights.
    stepped = scores(docs.orderBy(F.desc("doc_id")).coalesce(2), step=300)
    assert [r[:2] for r in stepped] == [r[:2] for r in one]
    assert max(abs(a[2] - b[2]) for a, b in zip(stepped, one)) < 1e-8


def test_more_classes_than_a_byte_holds(spark, documents):
    rows = [(i, " ".join(f"w{(i * k) % 997}" for k in range(1, 40))) for i in range(400)]
    corpus, known = lm.encoded(documents(rows), F.lit(False), classes=900, batch_bytes=1 << 20)
    found = [lm._numbers(*pa.array([r["classes"], r["codes"]], pa.binary()))[0] for r in corpus.collect()]
    assert 256 < len(known) and 256 < max(x.max() for x in found) < len(known)
    w, bias = lm.train(corpus, known, bits=10, rounds=1, step=512, rate=1.0)
    assert w.shape == (1024, len(known)) and np.isfinite(w).all()
    got = corpus.mapInArrow(lm._score(w, bias, 10, 512), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, in_class double, of_class double").collect()
    assert all(-3 * r["n_tokens"] < r["of_class"] < 0 for r in got)


def test_counts_are_those_of_the_features(spark, documents):
    """Observed and expected counts against plain sums over all words."""
    rows = [(i, " ".join(f"w{(i * k) % 17}" for k in range(1, 12))) for i in range(60)]
    corpus, known = lm.encoded(documents(rows), F.lit(False), classes=6, batch_bytes=1 << 20)
    rng = np.random.default_rng(1)
    weights = rng.normal(size=(256, len(known))).astype(np.float32)
    bias = rng.normal(size=len(known)).astype(np.float32)
    seen, due = np.zeros((2, *weights.shape))
    for r in corpus.collect():
        kinds, codes = lm._numbers(*pa.array([r["classes"], r["codes"]], pa.binary()))
        features = lm.feature_rows(codes, 8)
        p = lm.class_probabilities(weights, bias, features)
        for k, of_word, share in zip(kinds, features, p):
            for f in of_word:
                seen[f, k] += 1
                due[f] += share
    texts = corpus.select("classes", "codes")
    assert (lm._counts(texts, None, bias, 8, 64) == seen).all()
    assert np.abs(lm._counts(texts, weights, bias, 8, 64) - due).max() < 0.01


def test_language_model_without_training_rows(spark, documents):
    assert lm.score(documents([]), F.lit(False)).count() == 0
    row = lm.score(documents([(1, "a b")]), F.lit(True)).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"]) == (3, 0, 0, 0.0)


def plain_url(url):
    at = (url or "").find("://")
    if at < 0:
        return "", "", []
    rest = url[at + 3 :]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = host.translate(LOW)
    query = re.match(r"[^?#]*\?([^#]*)|", url)[1] or ""
    tokens = {"scheme:" + url[:at]} | {f"host:{x}" for x in host.split(".")}
    tokens |= {"path:" + re.sub("[0-9]+", "0", x) for x in path.split("/")}
    tokens |= {"query:" + re.match("[^=]*", x)[0] for x in query.split("&")}
    tokens.add("part:" + (url.partition("#")[2]))
    return host, path, sorted(t for t in tokens if not t.endswith(":"))


def plain_rule(host, path, rules):
    best = None
    for verdict, h, p in rules:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, verdict)
    return best


def plain_filter(rows, support, confidence):
    parts = {u: plain_url(u) for _, u in rows}
    ruled = {u: plain_rule(h, p, urls.RULES) for u, (h, p, _) in parts.items()}
    baskets = [(frozenset(parts[u][2]), ruled[u][1]) for _, u in rows if ruled[u]]
    seen, both = Counter(), Counter()
    for tokens, verdict in baskets:
        for n in range(1, len(tokens) + 1):
            for some in combinations(sorted(tokens), n):
                seen[some] += 1
                both[some, verdict] += 1
    least = math.ceil(support * len(baskets))
    mined = {k: n / seen[k[0]] for k, n in both.items() if n >= least and n / seen[k[0]] >= confidence}
    kept = [
        (conf, both[a, v] / len(baskets), list(a), v)
        for (a, v), conf in mined.items()
        if not any(v == v2 and set(b) < set(a) and c2 >= conf for (b, v2), c2 in mined.items())
    ]
    out = []
    for i, u in rows:
        host, path, tokens = parts[u]
        rule = ruled[u]
        hits = [r for r in kept if set(r[2]) <= set(tokens)] if not rule else []
        verdict = rule[1] if rule else max(hits)[3] if hits else "allow"
        out.append((i, host, path, rule[0] if rule else None, verdict, bool(hits)))
    return out


def test_url_filter_equals_brute_force(spark):
    rows = []
    for i in range(240):
        site = ("a.example.org", "B.Example.com", "c.example.net", "org", "example.org")[i % 5]
        lang = ("en", "de", "fr", "es")[i // 5 % 4]
        tail = ("", "?page=2&ref=x", "#top", ".html", "/")[i // 20 % 5]
        rows.append((i, f"http{'s' * (i % 2)}://{site}/{lang}/{i * 37 % 300}{tail}"))
    rows += [(500, None), (501, ""), (502, "no scheme.org/x"), (503, "://"), (504, "http://notexample.org"), (505, "http://EXAMPLE.ORG?x#y")]
    rows += [rows[3], (None, "https://x.com/de/1"), (506, "http://x.com/a://b.org/fr/")]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("rule", F.lit(1))
    for support, confidence in ((0.05, 0.8), (0.3, 0.6)):
        got = urls.filter_urls(df, min_support=support, min_confidence=confidence)
        found = sorted((tuple(r) for r in got.drop("url").collect()), key=str)
        assert found == sorted(plain_filter(rows, support, confidence), key=str)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "http://x.net/a"), (2, "http://y.org/")]])
def test_url_filter_with_little_to_mine(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string")
    assert len(urls.filter_urls(df).collect()) == len(rows)


def template_rows(n):
    """300 labelled URLs of one template with ``n`` parameters beside 300 others, and open ones."""
    query = "&".join(f"p{j}=1" for j in range(n))
    rows = [(i, f"https://shop.example.org/es/item{i % 7}?{query}") for i in range(300)]
    rows += [(300 + i, f"http://h{i % 40}.example.com/{('de', 'fr')[i % 2]}/{i % 9}") for i in range(300)]
    rows += [(600 + i, f"https://x{i}.net/{('es', 'de', 'other')[i % 3]}/?p{i % (n + 1)}=2") for i in range(60)]
    return rows


def test_tokens_of_a_template_are_one_item(spark):
    few = spark.createDataFrame(template_rows(3), "page_id long, url string")
    found = sorted((tuple(r) for r in urls.filter_urls(few).drop("url").collect()), key=str)
    assert found == sorted(plain_filter(template_rows(3), 0.01, 0.8), key=str)
    for n in (16, 40):  # as single tokens these would be 2**n frequent sets
        df = spark.createDataFrame(template_rows(n), "page_id long, url string")
        out = {r["page_id"]: r["verdict"] for r in urls.filter_urls(df).collect()}
        assert len(out) == 660 and out[600 + 1] == "block"
        parts = urls.with_parts(df)
        labelled = parts.select(urls.tokens().alias("tokens"), urls.curated(urls.RULES)["verdict"].alias("verdict"))
        rules = urls.mine(labelled.filter("verdict IS NOT NULL")).collect()
        assert len(rules) < 500 and max(len(g) for r in rules for g in r["antecedent"]) >= n
