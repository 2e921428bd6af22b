import math

import pytest
from pyspark.sql import functions as F

from quire.operators.index import build_index
from quire.operators.ranking import rank, score, query_terms
from quire.operators.structured import boolean_rank, fuzzy_expansion


@pytest.fixture(scope="module")
def index(spark):
    docs = spark.createDataFrame(
        [(1, "apple banana apple"), (2, "banana cherry"), (3, "cherry cherry cherry date"),
         (4, ",,, ...")],
        "doc_id long, contents string")
    return build_index(spark, docs, "standard")


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame([(1, "Apple cherry"), (2, "banana banana"), (3, "zzz")],
                                 "query_id long, text string")


def test_corpus_stats(index):
    c = index.corpus.first()
    assert (c["n_docs"], c["n_docs_nonempty"], c["n_tokens"]) == (4, 3, 9)
    assert c["avgdl"] == pytest.approx(3.0)


def test_jm_by_hand(index, queries):
    run = {(r["query_id"], r["doc_id"]): r["score"] for r in rank(index, queries, "jm", 0.5).collect()}
    # p(apple) = (2+1)/(9+1), doc 1: tf 2, dl 3
    s1 = math.log(1 + (0.5 * 2 / 3) / (0.5 * 0.3))
    assert run[(1, 1)] == pytest.approx(s1, abs=1e-6)
    # repeated query word counts twice
    p_ban = (2 + 1) / 10
    assert run[(2, 2)] == pytest.approx(2 * math.log(1 + (0.5 * 1 / 2) / (0.5 * p_ban)), abs=1e-6)
    assert not any(q == 3 for q, _ in run)                       # no hit -> no row


def test_zero_scores_order_by_doc_id(index, queries):
    for model, p in (("jm", 1.0), ("dirichlet", 0.0)):
        rows = rank(index, queries, model, p).filter("query_id = 1").orderBy("rk").collect()
        assert [r["doc_id"] for r in rows] == [1, 2, 3]
        assert all(r["score"] == 0 for r in rows)
    with pytest.raises(ValueError):
        rank(index, queries, "jm", 0.0)


def test_bm25_by_hand(index, queries):
    run = {(r["query_id"], r["doc_id"]): r["score"] for r in rank(index, queries, "bm25", None).collect()}
    idf = math.log(1 + (3 - 1 + 0.5) / (1 + 0.5))
    tfn = 2 / (2 + 1.2 * (0.25 + 0.75 * 3 / 3))
    assert run[(1, 1)] == pytest.approx(idf * tfn, abs=1e-6)


def test_boolean_counts_terms(index, queries):
    run = {(r["query_id"], r["doc_id"]): r["score"] for r in rank(index, queries, "boolean", None).collect()}
    assert run[(2, 1)] == 2.0 and run[(1, 3)] == 1.0


def test_grid_equals_single_runs(index, queries):
    qt = query_terms(queries, "standard")
    grid = {(r["param"], r["query_id"], r["doc_id"]): r["score"]
            for r in score(index, qt, "dirichlet", [0.0, 200.0, 2000.0]).collect()}
    for mu in (0.0, 200.0, 2000.0):
        single = {(r["query_id"], r["doc_id"]): r["score"]
                  for r in score(index, qt, "dirichlet", [mu]).collect()}
        assert single == {(q, d): s for (p, q, d), s in grid.items() if p == mu}


def test_must_and_must_not(spark, index):
    cl = spark.createDataFrame([(1, "banana", 1, "must"), (1, "apple", 1, "should"),
                                (2, "cherry", 1, "should"), (2, "date", 1, "must_not"),
                                (3, "apple", 1, "must_not")],
                               "query_id long, term string, qtf long, occur string")
    got = sorted((r["query_id"], r["doc_id"]) for r in boolean_rank(index, cl).collect())
    assert got == [(1, 1), (1, 2), (2, 2)]


def test_plan_shapes(index, queries):
    plan = rank(index, queries, "jm", 0.5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan          # top-k cut before the shuffle
    assert "BroadcastHashJoin" in plan         # query side broadcast into the postings scan


def test_tokenise_once(spark):
    from quire.operators.index import term_counts
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, contents string")
    plan = term_counts(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(lower(") == 1


def _lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def test_fuzzy_against_brute_force(spark):
    vocab = ["cat", "cart", "act", "at", "a", "", "scatter", "café", "cafe", "kate", "dog", "cot",
             "ctx", "tac", "caat", "cats"]
    q = ["cat", "cafe", "at"]
    terms = spark.createDataFrame([(v,) for v in vocab if v], "term string")
    qt = spark.createDataFrame([(1, t) for t in q], "query_id long, term string")
    got = {(r["term"], r["match"], r["distance"]) for r in fuzzy_expansion(terms, qt, 2).collect()}
    want = {(t, v, _lev(t, v)) for t in q for v in vocab if v and _lev(t, v) <= 2}
    assert got == want


def _osa_brute(a, b):
    from quire.operators.structured import _osa
    return _osa(a, b)


def test_fuzzy_transpositions(spark):
    vocab = ["cat", "act", "tac", "cta", "atc", "tca", "cart", "crat", "ca", "c", "dog", "cats"]
    q = ["cat", "crta"]
    terms = spark.createDataFrame([(v,) for v in vocab], "term string")
    qt = spark.createDataFrame([(1, t) for t in q], "query_id long, term string")
    got = {(r["term"], r["match"], r["distance"])
           for r in fuzzy_expansion(terms, qt, 1, transpositions=True).collect()}
    want = {(t, v, _osa_brute(t, v)) for t in q for v in vocab if _osa_brute(t, v) <= 1}
    assert got == want and ("cat", "act", 1) in got


def test_english_analyzer_end_to_end(spark):
    from quire.operators.index import build_index
    docs = spark.createDataFrame([(1, "The runner runs daily"), (2, "a quiet library"),
                                  (3, "Libraries and running")], "doc_id long, contents string")
    idx = build_index(spark, docs, "english")
    q = spark.createDataFrame([(1, "Running"), (2, "the libraries")], "query_id long, text string")
    got = {(r["query_id"], r["doc_id"]) for r in rank(idx, q, "bm25", None, 10).collect()}
    # run/runs/running share the stem "run"; library/libraries share "librari"; "the" is a stop word
    assert got == {(1, 1), (1, 3), (2, 2), (2, 3)}


def _wild(pattern, term):
    """Glob matching by recursion."""
    if not pattern:
        return not term
    if pattern[0] == "*":
        return any(_wild(pattern[1:], term[i:]) for i in range(len(term) + 1))
    return bool(term) and pattern[0] in ("?", term[0]) and _wild(pattern[1:], term[1:])


def test_wildcards_anywhere(spark):
    from quire.operators.structured import prefix_expansion, wildcard_expansion
    words = ["a", "ab", "abc", "abd", "axbyc", "bca", "cab", "é", "añc", "a.c", "a+b", "x" * 500, "[z]", "z\\d"]
    pats = ["a*", "*c", "a?c", "*b*", "?", "??", "*", "a*b*c", "a.c", "a+*", "[*", "zz*", "*x", "a**c", "z\\?", "é"]
    terms = spark.createDataFrame([(w,) for w in words], "term string")
    asked = spark.createDataFrame([(i, p) for i, p in enumerate(pats)], "query_id int, pattern string")
    got = {(r.pattern, r.term) for r in wildcard_expansion(terms, asked).collect()}
    assert got == {(p, w) for p in pats for w in words if _wild(p, w)}
    plain = spark.createDataFrame([(0, "a"), (0, "ab"), (1, "zz"), (1, "x")], "query_id int, pattern string")
    got = {(r.pattern, r.term) for r in prefix_expansion(terms, plain).collect()}
    assert got == {(p, w) for p in ("a", "ab", "zz", "x") for w in words if w.startswith(p)}


@pytest.mark.parametrize("prefixes", [True, False])
def test_wildcard_rank_expands_patterns_once(spark, monkeypatch, prefixes):
    """Ranks are those of a count per query and document; over 64 patterns; queries that
    share a pattern add no expansion."""
    import random
    from quire.operators import structured
    rng = random.Random(4)
    words = ["".join(rng.choices("abcde", k=rng.randrange(1, 5))) for _ in range(60)]
    texts = {i: rng.sample(words, rng.randrange(0, 9)) for i in range(40)}
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()] + [(90, None)], "doc_id long, contents string")
    made = sorted({w[:k] if prefixes else w[:k] + "?" * (k % 2) + "*" for w in words for k in (1, 2, 3, 4)})
    asked = [(q, p) for q in range(6) for p in rng.sample(made, 30)] + [(7, p) for p in made] + [(8, made[0]), (8, made[0]), (9, "zz")]
    patterns = spark.createDataFrame([*asked, (9, None)], "query_id int, pattern string")
    name, rows = "prefix_expansion" if prefixes else "wildcard_expansion", []
    real = getattr(structured, name)

    def seen(terms, pats):
        out = real(terms, pats)
        rows.append((out.count(), out.select("pattern", "term").distinct().count()))
        return out
    monkeypatch.setattr(structured, name, seen)
    got = [tuple(r) for r in structured.wildcard_rank(build_index(spark, docs), patterns, 5, prefixes).orderBy("query_id", "rk").collect()]
    want = []
    for q in sorted({q for q, _ in asked}):
        pats = {p for a, p in asked if a == q}
        n = {d: sum(any(_wild(p + "*" * prefixes, w) for w in t) for p in pats) for d, t in texts.items()}
        best = sorted((d for d in n if n[d]), key=lambda d: (-n[d], d))[:5]
        want += [(q, i + 1, d, float(n[d])) for i, d in enumerate(best)]
    assert got == want and len(made) > 64
    assert rows and all(every == once for every, once in rows)


def test_phrases_of_any_length(spark):
    from quire.operators.vectors import phrase_places
    docs = spark.createDataFrame([(1, "to be or not to be"), (2, "be to be"), (3, "not"), (4, None), (5, "a a a a"),
                                  (6, "be or to not be to be or")], "doc_id long, contents string")
    phrases = ["to be", "be", "to be or not to be", "or to", "a a", "a a a", "", "not to be or", "be or", "zebra be", "to be or zebra"]
    asked = spark.createDataFrame(list(enumerate(phrases)), "phrase_id int, text string")
    idx = build_index(spark, docs, positions=True)
    found = phrase_places(idx, asked)
    got = {(r.phrase_id, r.doc_id): r.n_places for r in found.collect()}
    want = {}
    for i, p in enumerate(phrases):
        for d in docs.collect():
            w, t = p.split(), (d.contents or "").split()
            n = sum(t[j:j + len(w)] == w for j in range(len(t) - len(w) + 1)) if w else 0
            if n:
                want[(i, d.doc_id)] = n
    assert got == want
    # no text is read: the plan scans postings, terms and query-side tables
    assert "contents" not in found._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        phrase_places(build_index(spark, docs), asked)


def test_phrases_make_no_rows_for_shared_words(spark, monkeypatch):
    """What phrases write does not grow with the documents that hold their words."""
    from quire.operators import vectors
    docs = spark.createDataFrame([(i, "the cat of the dog") for i in range(50)] + [(99, "dog of cat the")], "doc_id long, contents string")
    asked = spark.createDataFrame([(i, f"the cat of {'the' if i % 2 else 'cat'}") for i in range(8)], "phrase_id int, text string")
    idx, written, real = build_index(spark, docs, positions=True), [], vectors.materialize

    def counted(df, name):
        out = real(df, name)
        written.append(out.count())
        return out
    monkeypatch.setattr(vectors, "materialize", counted)
    got = {(r.phrase_id, r.doc_id): r.n_places for r in vectors.phrase_places(idx, asked).collect()}
    assert got == {(p, d): 1 for p in (1, 3, 5, 7) for d in range(50)}
    assert sum(written) <= 16
    # pieces of a long phrase: the last one overlaps, all must agree on the place
    long = spark.createDataFrame([(1, "a b a b a b c"), (2, "x a b a b a b"), (3, None)], "doc_id long, contents string")
    asked = spark.createDataFrame([(1, "a b a b a b"), (2, "b a b a b c"), (3, "a b a b c c"), (4, "a b")], "phrase_id int, text string")
    got = {(r.phrase_id, r.doc_id): r.n_places
           for r in vectors.phrase_places(build_index(spark, long, positions=True), asked).collect()}
    assert got == {(1, 1): 1, (1, 2): 1, (2, 1): 1, (4, 1): 3, (4, 2): 3}


def test_cut_by_thresholds_changes_no_rank(spark, monkeypatch):
    """Rows below a score that enough documents reach go before the ranking; ties at the
    cut and queries with few hits stay whole."""
    import random
    from quire.operators import ranking
    rng = random.Random(2)
    docs = spark.createDataFrame([(i, " ".join(rng.choices("abcdefgh", weights=(30, 20, 9, 8, 7, 3, 2, 1), k=rng.randrange(1, 12))))
                                  for i in range(400)], "doc_id long, contents string")
    idx = build_index(spark, docs)
    q = spark.createDataFrame([(1, "a b c"), (2, "h g"), (3, "a"), (4, "zzz h"), (5, "b d e f g h")], "query_id long, text string")
    specs = [("jm", 0.0), ("jm", 0.3), ("jm", 1.0), ("dirichlet", 0.0), ("dirichlet", 50.0), ("bm25", 0.0)]
    qt = ranking.query_terms(q)
    for share in (2, 16, 1000):
        monkeypatch.setattr(ranking, "THRESHOLD_SHARE", share)
        whole = ranking.score(idx, qt, None, specs)
        part = ranking.score(idx, qt, None, specs, cut=5)
        a, b = (sorted(map(tuple, ranking.top_k(x, 5).select("spec", "query_id", "rk", "doc_id", "score").collect())) for x in (whole, part))
        assert a == b
        assert share == 1000 or part.count() < 0.6 * whole.count()
    # the grid takes this way from a number of documents on, with the same result
    want = sorted(map(str, ranking.rank_grid(idx, q, None, specs, 5).collect()))
    spark.conf.set(ranking.CONF_THRESHOLD_DOCS, "100")
    try:
        assert sorted(map(str, ranking.rank_grid(idx, q, None, specs, 5).collect())) == want
    finally:
        spark.conf.unset(ranking.CONF_THRESHOLD_DOCS)


def test_counted_join_splits_keys_by_their_rows(spark):
    from quire.operators.joins import CONF_MAX_ROWS, CONF_ROWS_PER_SALT, counted_join
    big = spark.range(900).selectExpr("id", "if(id % 3 = 0, 'hot', concat('t', id % 40)) as term")
    small = big.groupBy("term").count().withColumnRenamed("count", "df")
    want = sorted(map(tuple, big.join(small, "term").select("id", "term", "df").collect()))
    spark.conf.set(CONF_ROWS_PER_SALT, "50")
    try:
        j = counted_join(big, small, "term", "df", "id")
        assert sorted(map(tuple, j.select("id", "term", "df").collect())) == want
        spark.conf.set(CONF_MAX_ROWS, "0")               # too many split keys to broadcast
        assert sorted(map(tuple, counted_join(big, small, "term", "df", "id").select("id", "term", "df").collect())) == want
    finally:
        spark.conf.unset(CONF_ROWS_PER_SALT)
        spark.conf.unset(CONF_MAX_ROWS)


def test_very_long_fuzzy_term(spark):
    import random
    rng = random.Random(3)
    long = "".join(rng.choice("abcd") for _ in range(3000))
    near = long[:1000] + "x" + long[1001:2000] + long[2001:]
    terms = spark.createDataFrame([(long,), (near,), (long[:2990],), (long[1:] + "ab",), ("b",)], "term string")
    q = spark.createDataFrame([(1, long), (2, "")], "query_id int, term string")
    got = {(r.query_id, r.match, r.distance) for r in fuzzy_expansion(terms, q, 2).collect()}
    assert got == {(1, long, 0), (1, near, 2), (2, "b", 1)}


def test_fuzzy_leaves_out_long_terms_before_neighbourhoods(spark):
    terms = spark.createDataFrame([("x" * 5000,), ("fox",), ("foxes",), ("f",)], "term string")
    q = spark.createDataFrame([(1, "fox")], "query_id int, term string")
    assert {r.match for r in fuzzy_expansion(terms, q, 2).collect()} == {"fox", "foxes", "f"}


def test_best_hits_from_blocks_are_those_of_the_join(spark, monkeypatch):
    """No row per query and posting is made for a batch that can be sent to the tasks; ids
    that repeat or are null, ties at the cut and scores of 0 come out as joined."""
    import random
    from quire.operators import docscores, ranking
    from quire.operators.joins import CONF_MAX_ROWS
    from quire.sources.tables import derived_qrels
    rng = random.Random(5)
    docs = spark.createDataFrame([(rng.choice([None, *range(250)]), " ".join(rng.choices("abcdefgh", weights=(30, 20, 9, 8, 7, 3, 2, 1), k=rng.randrange(1, 12))))
                                  for _ in range(400)], "doc_id long, contents string")
    idx = build_index(spark, docs)
    q = spark.createDataFrame([(1, "a b c a"), (2, "h g"), (3, "a"), (3, "a d"), (4, "zzz h"), (None, "b d")], "query_id int, text string")
    specs = [("jm", 0.0), ("jm", 0.3), ("jm", 1.0), ("dirichlet", 0.0), ("dirichlet", 50.0), ("bm25", 0.0)]

    def results():
        run = ranking.rank_grid(idx, q, None, specs, 5)
        none = ranking.rank_grid(idx, q, "jm", [spark.sql("SELECT CAST(null AS DOUBLE) AS p").scalar()], 3)
        qrels = derived_qrels(q, idx.postings, 0.5)
        return [sorted(map(str, x.select("query_id", "doc_id", *(["spec", "model", "param", "score", "rk"] if x is not qrels else [])).collect()))
                for x in (run, none, qrels)]
    spark.conf.set(CONF_MAX_ROWS, "0")
    try:
        want = results()
    finally:
        spark.conf.unset(CONF_MAX_ROWS)
    monkeypatch.setattr(ranking, "score", None)
    for docs_at_once, scores in ((3, 200), (32, 2_000_000)):
        monkeypatch.setattr(docscores, "DOCS_AT_ONCE", docs_at_once)
        monkeypatch.setattr(docscores, "SCORES_AT_ONCE", scores)
        assert results() == want
    assert len(want[0]) > 100 and want[1] and want[2]


def test_query_table_is_bounded(spark, monkeypatch):
    from quire.operators import docscores
    qt = query_terms(spark.createDataFrame([(1, "a b"), (2, "c d")], "query_id long, text string"))
    assert docscores.query_table(qt).counts().sum() == 4
    monkeypatch.setattr(docscores, "MAX_QUERY_CELLS", 7)
    assert docscores.query_table(qt) is None


def _counted_patterns(asked, texts, cut, prefixes):
    """(query, rk, doc, score) by a count of each query's patterns in each document."""
    want = []
    for q in sorted({q for q, _ in asked}):
        pats = {p for a, p in asked if a == q}
        n = {d: sum(any(_wild(p + "*" * prefixes, w) for w in t) for p in pats) for d, t in texts.items()}
        want += [(q, i + 1, d, float(n[d])) for i, d in enumerate(sorted((d for d in n if n[d]), key=lambda d: (-n[d], d))[:cut])]
    return want


def test_postings_of_frequent_expanded_terms_are_not_shuffled(spark, monkeypatch):
    """Of more expanded terms than are broadcast, the frequent ones still are, and only
    postings of the others are joined by a shuffle."""
    from quire.operators import structured
    common, texts = [f"a{c}z" for c in "bcde"], {}
    for i in range(60):
        texts[i] = common + [f"a{i:02d}xz", f"b{i % 7}z"]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, contents string")
    asked = [(0, "a*z"), (0, "a?z"), (1, "*xz"), (1, "a*"), (2, "*"), (2, "b3*"), (3, "*1x*"), (4, "none*")]
    index, shuffled = build_index(spark, docs), []
    real = structured.counted_join

    def seen(big, *args, **kwargs):
        shuffled.append(big.count())
        return real(big, *args, **kwargs)
    monkeypatch.setattr(structured, "counted_join", seen)
    patterns = spark.createDataFrame(asked, "query_id int, pattern string")
    monkeypatch.setattr(structured, "SENT_TERMS", 12, raising=False)
    spark.conf.set("quire.broadcast.maxRows", "40")
    try:
        got = [tuple(r) for r in structured.wildcard_rank(index, patterns, 5, False).orderBy("query_id", "rk").collect()]
    finally:
        spark.conf.unset("quire.broadcast.maxRows")
    assert got == _counted_patterns(asked, texts, 5, False)
    assert index.postings.count() == 360 and shuffled == [60]


def test_wildcards_of_any_shape(spark):
    """Keys of both ends, of one, of neither; other columns stay; null matches nothing."""
    import random
    from quire.operators.structured import wildcard_expansion
    rng = random.Random(9)
    words = sorted({"".join(rng.choices("abé.", k=rng.randrange(1, 9))) for _ in range(300)})
    pats = sorted({"".join(rng.choices("abé.*?*", k=rng.randrange(1, 8))) for _ in range(150)} | {"ab*abab*ba", "?bab*", "*a?", "abab", "ab*ba"})
    terms = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "term string, df int")
    asked = spark.createDataFrame([*enumerate(pats), (900, None)], "query_id int, pattern string")
    rows = [(r.pattern, r.term, r.df) for r in wildcard_expansion(terms, asked).collect()]
    assert sorted(rows) == sorted((p, w, i) for p in pats for i, w in enumerate(words) if _wild(p, w))


def test_wildcard_queries_are_counted_some_documents_at_a_time(spark, monkeypatch):
    """Far fewer rows than pairs of a query and a document leave the tasks, in blocks of few
    documents too; more queries than are sent to the tasks are joined, with equal ranks.
    Null queries and null documents are one each."""
    from quire.operators import docscores, structured
    texts = {i: [f"w{(i * k) % 11}" for k in range(1, 6)] for i in range(200)}
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()] + [(None, "w1 w2")], "doc_id long, contents string")
    asked = [(q, p) for q in range(20) for p in (f"w{q % 11}", f"w{(q + 3) % 11}", "w1", f"w{q % 4}")]
    patterns = spark.createDataFrame([*asked, (None, "w2"), (None, "w1"), (3, None)], "query_id int, pattern string").coalesce(1)
    index, made = build_index(spark, docs.coalesce(1)), []
    real = structured.most_bits

    def seen(*args):
        out = real(*args)
        made.append(out.count())
        return out
    monkeypatch.setattr(structured, "most_bits", seen)

    def ranked():
        return sorted(map(tuple, structured.wildcard_rank(index, patterns, 3).collect()), key=str)
    whole = ranked()
    monkeypatch.setattr(docscores, "SCORES_AT_ONCE", 100)
    assert ranked() == whole
    monkeypatch.setattr(structured, "MAX_QUERY_ROWS", 1)
    assert ranked() == whole
    assert len(made) == 2 and made[0] <= 8 * 21 * 3 and {q for q, *_ in whole} == {*range(20), None}
    assert any(d is None for *_, d, _ in whole)
    known = {d: t for d, t in texts.items()} | {-1: ["w1", "w2"]}
    want = _counted_patterns([(-1 if q is None else q, p) for q, p in [*asked, (None, "w2"), (None, "w1")]], known, 3, True)
    assert sorted((tuple(-1 if v is None else v for v in r) for r in whole)) == sorted(want)
