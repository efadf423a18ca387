from quarry.functions.stemmer import porter_stem, stem_token_arrays

# Examples given in the 1980 paper (input, stem after all steps).
PAPER = {
    "caresses": "caress", "ponies": "poni", "ties": "ti", "cats": "cat", "feed": "feed", "agreed": "agre",
    "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing", "conflated": "conflat",
    "troubled": "troubl", "sized": "size", "hopping": "hop", "tanned": "tan", "falling": "fall",
    "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file", "happy": "happi", "sky": "sky",
    "relational": "relat", "conditional": "condit", "rational": "ration", "digitizer": "digit",
    "vietnamization": "vietnam", "predication": "predic", "operator": "oper", "feudalism": "feudal",
    "decisiveness": "decis", "hopefulness": "hope", "callousness": "callous", "formaliti": "formal",
    "sensitiviti": "sensit", "sensibiliti": "sensibl", "triplicate": "triplic", "formative": "form",
    "electrical": "electr", "goodness": "good", "revival": "reviv", "allowance": "allow",
    "inference": "infer", "airliner": "airlin", "adjustable": "adjust", "defensible": "defens",
    "replacement": "replac", "adoption": "adopt", "communism": "commun", "activate": "activ",
    "homologous": "homolog", "effective": "effect", "bowdlerize": "bowdler", "probate": "probat",
    "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll", "generalizations": "gener",
}


def test_paper_examples():
    assert {w: porter_stem(w) for w in PAPER} == PAPER


def test_short_and_none():
    assert porter_stem("is") == "is"
    assert porter_stem(None) is None


def test_stem_token_arrays_keeps_order_and_nulls(spark):
    df = spark.createDataFrame([(1, ["ponies", "running", "cats"]), (2, None), (3, [])], "doc_id long, tokens array<string>")
    out = {r.doc_id: r.tokens for r in stem_token_arrays(df, "tokens").collect()}
    assert out[1] == ["poni", "run", "cat"]
    assert out[2] is None
    assert out[3] == []


def test_stems_are_made_where_the_rows_are(spark):
    """Rows of one id, null, empty and null tokens; no shuffle, and a filter on stems does not stem twice."""
    df = spark.createDataFrame([(1, ["running", None, "cats"]), (1, ["cats"]), (2, None), (3, [])], "doc_id long, tokens array<string>")
    out = stem_token_arrays(df)
    assert sorted((r["doc_id"], r["tokens"]) for r in out.where("doc_id < 2 or doc_id = 3").collect()) == [(1, ["cat"]), (1, ["run", "cat"]), (3, [])]
    assert [r["doc_id"] for r in out.where("tokens is null").collect()] == [2]
    plan = out.where("size(tokens) > 1")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("ArrowEvalPython") == 1
