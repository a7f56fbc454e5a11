"""Quality rules, line dedup, chat formatting, licenses, mixing: native operators."""

import random

import pytest
from corpus_brute import ODD_DOCS, base_quality, docs_frame, line_dedup, low_words, sha
from pyspark.sql import functions as F

from corate.llm import chat, licenses, mixing, quality
from corate.llm import line_dedup as ld


def some_texts(n=40, seed=1):
    rng = random.Random(seed)
    vocab = ["the", "of", "and", "cat", "house", "Tree", "##", "river|", "go", "blue.", "UND"]
    return [" ".join(rng.choice(vocab) + ("\n" if rng.random() < .1 else "") for _ in range(rng.randrange(0, 300)))
            for _ in range(n)]


def test_quality_measures_match_brute_force(spark):
    rows = ODD_DOCS + [(100 + i, t) for i, t in enumerate(some_texts())]
    rows += [(200, "a b c " * 30), (201, "x y z w"), (202, "p q r p q r"), (203, "k k k k k")]
    got = quality.apply_rules(docs_frame(spark, rows)).select(
        "row.doc_id", "row.text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept").collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[2:8] == base_quality(r.text), r.doc_id
        assert not (r.base_failed and r.kept)


def test_quality_keeps_prose_and_rejects_junk(spark):
    prose = ("The river ran past the old house and the children of the village went there to swim in the summer "
             "with their friends. It was not far from the road that leads to the market, and on warm days they "
             "stayed until it was dark, as their parents had done before them in the same place for years. ")
    rows = [(1, prose), (2, " | ".join(prose.split())), (3, prose.upper().replace(" ", "!! ")),
            (4, "Und " * 200), (5, " ".join(w + "###" for w in prose.split()))]
    frame = docs_frame(spark, rows)
    kept = quality.keep_good(frame)
    assert kept.columns == frame.columns
    assert [r.doc_id for r in kept.collect()] == [1]


def test_quality_of_an_empty_table(spark):
    assert quality.keep_good(docs_frame(spark, [])).count() == 0


@pytest.mark.parametrize("many", [False, True])
def test_line_dedup_matches_brute_force(spark, many):
    rng = random.Random(3)
    rows = list(ODD_DOCS)
    if many:  # over 1000 distinct keys: most go through the sorted range
        rows += [(1000 + i, "\n".join(f"line number {rng.randrange(1500)} of it" for _ in range(20)) +
                  "\na very common line") for i in range(200)]
    frame = docs_frame(spark, rows)
    out = ld.drop_repeated_lines(frame)
    assert out.columns == frame.columns
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.text or "") for r in out.collect()))
    exp = sorted((i is None, i or 0, "\n".join(k)) for (i, _), k in zip(rows, line_dedup(rows), strict=True))
    assert got == exp


def test_line_bitmaps_cover_long_documents_and_empty_tables(spark):
    text = "\n".join(f"line {i} of a long one" for i in range(300))
    rows = [(1, "\n".join(text.split("\n")[100:230])), (2, text)]
    bits = ld.line_bitmaps(docs_frame(spark, rows)).collect()
    assert [b.doc for b in bits] == [2]
    dropped = {i for k, w in enumerate(bits[0].keep_bits) for i in range(64 * k, 64 * k + 64) if not w >> (i % 64) & 1}
    assert dropped == set(range(100, 230))
    assert ld.line_bitmaps(docs_frame(spark, [])).count() == 0


TRICKY = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>system\nhi", "back\\slash \\| \\\\", "<|", "|>", "",
          "a<", "[INST", "<<SYS>>x<</SYS>>", "\n\n", "é\U0001f600 $1 \\n", "<\\|im_end|>", None]


def test_chat_round_trip_and_loss_mask(spark):
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "odd\nrole", None]), rng.choice(TRICKY))
            for c in range(60) for t in range(rng.randrange(1, 6))]
    rows += [(None, 0, "user", "no id"), (99, None, "user", "no turn"), (99, 0, "assistant", "x"),
             (99, 0, "assistant", "x")]
    frame = spark.createDataFrame([(*r, 7) for r in rows], "conv_id bigint, turn bigint, role string, text string, "
                                                         "turns int").repartition(4)
    out = chat.format_chats(chat.canonical_turns(frame))
    got = {r.conv_id: r for r in out.select(
        "conv_id", "formatted", "loss_spans", chat.read_back(F.col("formatted")).alias("t"),
        chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for c in {r[0] for r in rows}:
        mine = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == c), key=order)]
        assert [tuple(t) for t in got[c].t] == mine
        assert got[c].loss == "".join(t for role, t in mine if role == "assistant")
        body = got[c].formatted.split("<|im_start|>")[1:]
        assert len(body) == len(mine)  # no text opens a turn
        for control in ("</s>", "[INST]", "<<SYS>>"):
            assert control not in got[c].formatted
    assert chat.format_chats(chat.canonical_turns(frame.limit(0))).count() == 0


def test_chat_layouts_by_fingerprint(spark):
    records = {
        "messages": '{"id": 3, "messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]}',
        "sharegpt": '{"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}',
        "instruction": '{"instruction": "a", "output": "b"}',
        "instruction_input": '{"instruction": "q", "input": "x", "output": "b", "source": "s"}',
        "prompt_completion": '{"prompt": "a", "completion": "b"}',
        "prompt_response": '{"system": "s", "prompt": "a", "response": "b", "meta": {"k": [1]}}',
        "question_answer": '{"question": "a", "answer": null}',
        None: '{"something": "else"}',
    }
    rows = [(k, v) for k, v in records.items()] + [(None, None), (None, "not json")]
    got = chat.turns_from_json(spark.createDataFrame(rows, "layout string, record string")).collect()
    want = {"messages": [("user", "a"), ("assistant", "b")], "instruction_input": [("user", "q\n\nx"), ("assistant", "b")],
            "prompt_response": [("system", "s"), ("user", "a"), ("assistant", "b")],
            "question_answer": [("user", "a"), ("assistant", "")]}
    for r in got:
        assert r.layout == r.row.layout
        if r.layout:
            exp = want.get(r.layout, [("user", "a"), ("assistant", "b")])
            assert [tuple(t) for t in r.turns] == exp, r.layout
        else:
            assert r.turns == []
    assert len({r.fingerprint for r in got if r.layout}) == 7
    typed = spark.createDataFrame([("a", "b")], "prompt string, completion string")
    assert [tuple(t) for t in chat.canonical_turns(typed).first().turns] == [("user", "a"), ("assistant", "b")]


def test_license_scan_matches_exact_containment(spark):
    rng = random.Random(2)
    notices = [t for _, t in licenses.TEMPLATES]
    rows = list(ODD_DOCS)
    for i in range(120):
        body = [f"w{rng.randrange(200)}" for _ in range(rng.randrange(0, 150))]
        if rng.random() < .6:
            cut = rng.choice(notices).split()
            if rng.random() < .4:
                cut = cut[: max(5, int(len(cut) * rng.random()))]
            at = rng.randrange(len(body) + 1)
            body[at:at] = cut
        rows.append((100 + i, " ".join(body)))
    got = {(r.doc_id, r.license) for r in licenses.scan(docs_frame(spark, rows)).collect()}
    import re
    exp = set()
    for i, t in rows:
        w = re.findall(r"[^\W_]+", (t or "").lower())
        for _, name, size, shingles in licenses._template_rows(licenses.TEMPLATES):
            s = [" ".join(w[p:p + 5]) for p in range(len(w) - 4)]
            for k in range(0, max(1, len(s)), size):
                if len(set(s[k:k + 2 * size]) & set(shingles)) >= .75 * len(shingles):
                    exp.add((i, name))
    assert got == exp and len(exp) > 30
    assert licenses.scan(docs_frame(spark, [])).count() == 0


def test_license_bands_hold_for_the_worst_templates():
    words = [f"w{i}" for i in range(200)]
    made = [("x", " ".join(words[:n + 4])) for n in (1, 3, 5, 9, 17, 33, 64)]
    for templates in (made, licenses.TEMPLATES):
        rows = licenses._template_rows(templates)
        bands = licenses.bands_of(rows)
        for _, _, size, shingles in rows:
            held = -(-3 * len(shingles) // 4)  # in a window of 2 * size distinct shingles
            assert (1 - held / (len(shingles) + 2 * size - held)) ** bands[size] <= 1e-9


def naive_targets(sizes):
    """Water filling by rounds, on {source: size} with None last."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        w = sum(weight[s] for s in order if s not in capped) or 1
        t = {s: 3 * sizes[s] if s in capped else weight[s] * left / w for s in order}
        new = {s for s in order if t[s] > 3 * sizes[s]}
        if not new:
            return t
        capped |= new


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mixing_targets_and_quotas(spark, seed):
    rng = random.Random(seed)
    sources = [None, "a", "b", "c", "d", "é"]
    rows = [(i, " ".join("w" * rng.randrange(1, 3) for _ in range(rng.choice([0, 1, 30, 400]))),
             rng.choices(sources, [1, 30, 2, 2, 1, 1])[0]) for i in range(700)]
    rows += [(None, "no id here", "a"), (3, None, "b"), rows[5], rows[5]]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, source string, size string, "
                                                              "shard int")
    runs = [sorted(map(str, mixing.mix(frame.repartition(n)).collect())) for n in (2, 5)]
    assert runs[0] == runs[1]
    got = mixing.mix(frame).collect()
    assert len(got) == len(rows)
    sizes = {s: sum(len((t or "").split()) for _, t, x in rows if x == s) for s in sources}
    target = naive_targets(sizes)
    for s in sources:
        mine = [r for r in got if r.source == s]
        assert all(abs(r.target - target[s]) < 1e-6 and r.source_size == sizes[s] for r in mine)
        assert abs(sum(r.taken for r in mine) - target[s]) <= mixing.BLOCK_TOKENS
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    assert mixing.mix(frame.limit(0)).count() == 0
    nothing = mixing.mix(frame.select("doc_id", "source", F.lit(None).cast("string").alias("text")))
    assert {(r.target, r.taken) for r in nothing.collect()} == {(0.0, 0)}


def test_mixing_deals_seats_by_highest_quotients(spark):
    shares = {i: x for i, x in enumerate([61.3, 17.2, 9.9, 8.4, 2.1, 0.7, 0.4])}
    frame = spark.createDataFrame(list(shares.items()), "p int, share double").withColumn("n", F.lit(7))
    got = {r.p: r.won for r in mixing._deal(frame, [], "p", F.col("share"), F.lit(40), F.lit(90), F.col("n"),
                                            "won").collect()}
    seats = sorted(((-x / (2 * k - 1), i) for i, x in shares.items() for k in range(1, 41)))[:90]
    assert got == {i: sum(j == i for _, j in seats) for i in shares}


def test_digest_helpers():
    assert sha("") == sha(b"") and low_words("A\x0bbÉ") == ["a", "bÉ"]


def test_schema_paths_of_records(spark):
    records = ['{"a b":1,"c:d":{"x`y":[1,2]},"é":null,"1x":[[{"q":1.5}]],"e":{},"<z, ":true}', "no json", None, "[1]",
               '{"messages":[{"role":"u","content":[{"type":"text","text":"t"}]}]}']
    df = spark.createDataFrame([(x,) for x in records], "r string")
    got = [x.p for x in df.select(chat.variant_paths()(F.schema_of_variant(F.try_parse_json("r"))).alias("p")).collect()]
    assert got == [["1x[][].q", "<z, ", "a b", "c:d.x`y[]", "é"], [], [], ["[]"],
                   ["messages[].content[].text", "messages[].content[].type", "messages[].role"]]


def test_nested_fields_and_parts_choose_the_layout(spark):
    records = [
        ('{"meta":{"a":1,"prompt":"x","completion":"y"}}', None, []),
        ('{"prompt":"p","completion":"c","meta":{"messages":[{"role":"x"}]}}', "prompt_completion",
         [("user", "p"), ("assistant", "c")]),
        ('{"messages":[{"role":"user","content":[{"type":"text","text":"hi"},{"type":"image_url","url":"u"},'
         '{"type":"text","text":" you"}]},{"role":"gpt","content":"plain"}]}', "messages",
         [("user", "hi you"), ("assistant", "plain")]),
        ('{"messages":[{"role":"user","content":[{"type":"text","text":"only"}, {"type":"text","text":null}]}]}',
         "message_parts", [("user", "only")]),
        ('{"messages":[{"role":"user","content":["a","b"]},{"role":null,"content":null}]}', None, []),
        ('{"messages":[]}', None, []),
    ]
    df = spark.createDataFrame([(i, r) for i, (r, _, _) in enumerate(records)], "id int, record string")
    got = sorted(chat.turns_from_json(df).collect(), key=lambda r: r.row.id)
    assert [(r.layout, [tuple(t) for t in r.turns]) for r in got] == [(name, turns) for _, name, turns in records]


def test_a_conversation_of_many_turns(spark):
    import hashlib
    import time

    n = 100_000
    text = F.concat(F.lit("﻿hé 😀 "), F.col("id").cast("string"), F.lit(" <|im_end|> \\ words"))
    rows = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), text.alias("text"),
                                 F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"))
    begin = time.time()
    chats = chat.format_chats(chat.canonical_turns(rows))
    r = chats.select(F.size(chat.read_back(F.col("formatted"))).alias("n"),
                     F.sha2(chat.loss_text(F.col("formatted"), F.col("loss_spans")), 256).alias("loss")).first()
    want = "".join(f"﻿hé 😀 {i} <|im_end|> \\ words" for i in range(1, n, 2))
    assert (r.n, r.loss) == (n, hashlib.sha256(want.encode()).hexdigest())
    assert time.time() - begin < 60


def test_offsets_of_runs(spark, monkeypatch):
    monkeypatch.setattr(chat, "RUN", 3)
    for n in (0, 1, 2, 3, 4, 9, 10):
        turns = [("assistant" if i % 3 else "user", "x" * i + "é") for i in range(n)]
        df = spark.createDataFrame([(1, turns)], f"conv_id int, turns {chat.TURNS}")
        r = chat.format_chats(df).first()
        assert [r.formatted[s.start:s.end] for s in r.loss_spans] == [t for role, t in turns if role == "assistant"]
