from pyspark.sql import functions as F

from quire.functions.analysis import token_array
from quire.functions.stemmers import porter_stem, spanish_light_stem
from quire.operators.index import term_counts


def _toks(spark, text, analyzer):
    df = spark.createDataFrame([(text,)], "t string")
    return df.select(token_array(F.col("t"), analyzer).alias("a")).first()["a"]


def test_analyzers(spark):
    t = "The Cat's hat, THE end-game 3,14 x_y ünïcode"
    assert _toks(spark, t, "whitespace") == ["The", "Cat's", "hat,", "THE", "end-game", "3,14",
                                             "x_y", "ünïcode"]
    assert _toks(spark, t, "simple") == ["the", "cat", "s", "hat", "the", "end", "game", "x", "y",
                                         "ünïcode"]
    assert _toks(spark, t, "standard") == ["the", "cat", "s", "hat", "the", "end", "game", "3", "14",
                                           "x", "y", "ünïcode"]
    assert _toks(spark, t, "standard_uax") == ["the", "cat's", "hat", "the", "end", "game", "3,14",
                                               "x_y", "ünïcode"]
    assert _toks(spark, t, "stop") == ["cat", "s", "hat", "end", "game", "x", "y", "ünïcode"]
    assert _toks(spark, "  whole text  ", "keyword") == ["whole text"]
    # possessive removed, stop words removed (stemming is a vocabulary job)
    assert _toks(spark, t, "english") == ["cat", "hat", "end", "game", "3,14", "x_y", "ünïcode"]


def test_empty_and_no_token_text(spark):
    assert _toks(spark, "", "standard") == []
    assert _toks(spark, " ,.; ", "standard") == []


def test_porter_examples():
    pairs = {"caresses": "caress", "ponies": "poni", "agreed": "agre", "plastered": "plaster",
             "motoring": "motor", "hopping": "hop", "filing": "file", "happy": "happi",
             "relational": "relat", "generalizations": "gener", "oscillators": "oscil",
             "adjustable": "adjust", "controll": "control", "sky": "sky"}
    for w, s in pairs.items():
        assert porter_stem(w) == s, w


def test_spanish_light_stem():
    assert spanish_light_stem("chicas") == "chic"
    assert spanish_light_stem("luces") == "luz"
    assert spanish_light_stem("árboles") == "arbol"
    assert spanish_light_stem("casa") == "casa"      # shorter than 5: unchanged


def test_stemmed_term_counts(spark):
    df = spark.createDataFrame([(1, "Running runs runner's runs")], "doc_id long, contents string")
    got = {r["term"]: r["tf"] for r in term_counts(df, "english").collect()}
    assert got == {"run": 3, "runner": 1}
    dl = {r["dl"] for r in term_counts(df, "english").collect()}
    assert dl == {4}


def test_term_vector_offsets(spark):
    from quire.operators.vectors import term_vectors
    df = spark.createDataFrame([(1, "Héllo, wörld! hello")], "doc_id long, contents string")
    got = {r["term"]: (r["freq"], r["positions"], r["start_offsets"], r["end_offsets"])
           for r in term_vectors(df, offsets=True).collect()}
    assert got == {"héllo": (1, [0], [0], [5]), "wörld": (1, [1], [7], [12]),
                   "hello": (1, [2], [14], [19])}


def test_spanish_stop_words_by_default(spark):
    from quire.functions.analysis import SPANISH_STOP_WORDS, token_array
    from pyspark.sql import functions as F
    assert {"de", "también", "estuviéramos", "habríais", "fuésemos", "tenidas", "tuvieron", "eres"} <= set(SPANISH_STOP_WORDS)
    df = spark.createDataFrame([("Los niños estuvieron en la casa también",)], "t string")
    assert df.select(token_array(F.col("t"), "spanish")).first()[0] == ["niños", "casa"]
    assert df.select(token_array(F.col("t"), "spanish", ("casa",))).first()[0][:2] == ["los", "niños"]


def test_stems_inside_the_row(spark):
    """Stems are counted with the text's own rows: nothing is shuffled or joined where texts stay
    apart, and texts of one id and length are counted together otherwise."""
    from collections import Counter

    from quire.functions.analysis import token_array
    from quire.functions.stemmers import porter_stem
    from quire.operators.index import term_counts

    rows = [(1, "Running runs the runner's run"), (1, "Running runs the runner's run"), (2, None), (3, ""), (None, "the cats' cat")]
    docs = spark.createDataFrame(rows * 3, "doc_id long, contents string").coalesce(1)
    apart = term_counts(docs, "english", united=False)
    plan = apart._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    words = [(r[0], [porter_stem(w) for w in r[1] or []]) for r in docs.select("doc_id", token_array("contents", "english")).collect()]
    want = Counter((i, t, n, len(w)) for i, w in words for t, n in Counter(w).items())
    assert Counter(tuple(r) for r in apart.collect()) == want
    together = Counter()
    for (i, t, n, dl), k in want.items():
        together[i, t, dl] += n * k
    for buckets in (None, 4):
        got = {(r["doc_id"], r["term"], r["dl"]): r["tf"] for r in term_counts(docs, "english", buckets=buckets).collect()}
        assert got == together
    placed = {(r["term"], tuple(r["positions"])) for r in term_counts(docs.filter("doc_id is null").limit(1), "english", positions=True).collect()}
    assert placed == {("cat", (0, 1))}


def test_offsets_without_copying_arrays(spark, monkeypatch):
    from quire.operators import vectors
    monkeypatch.setattr(vectors, "GATHERED", 2)
    texts = [(1, "B b, a"), (2, None), (None, "  "), (3, "ab " * 3000), (1, "Ünï b"), (4, "--x--X")]
    made = vectors.term_vectors(spark.createDataFrame(texts, "doc_id long, contents string").coalesce(1), offsets=True)
    got = sorted((r.doc_id, r.term, r.freq, r.positions[:2], r.start_offsets[:2], r.end_offsets[-1]) for r in made.collect())
    assert got == [(1, "a", 1, [2], [5], 6), (1, "b", 1, [1], [4], 5), (1, "b", 2, [0, 1], [0, 2], 3), (1, "ünï", 1, [0], [0], 3),
                   (3, "ab", 3000, [0, 1], [0, 3], 8999), (4, "x", 2, [0, 1], [2, 5], 6)]
    assert made.columns == ["doc_id", "term", "freq", "positions", "start_offsets", "end_offsets"]
    assert "array_append" not in made._jdf.queryExecution().toString()


def test_runs_cut_plain_arrays(spark):
    from quire.functions.analysis import runs
    df = spark.createDataFrame([([("a", 1, 5), ("a", 2, 6), ("b", 0, 7)],), ([],), (None,)], "o array<struct<term:string,p:int,e:bigint>>")
    made = df.select(runs(F.col("o"), ("p", "e")).alias("c"))
    assert [r.c and [(x.term, x.tf, x.p, x.e) for x in r.c] for r in made.collect()] == [
        [("a", 2, [1, 2], [5, 6]), ("b", 1, [0], [7])], None, None]
    assert "slice(o#" not in made._jdf.queryExecution().optimizedPlan().toString()
