import random

import public_tokenizers
import pytest
from conftest_data import ODD
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from reviewloom.llm import chat, contamination, html, tokens, toxicity

BPE = public_tokenizers.path("byte_bpe_50k.json")


def plain_distance(item, text):
    """Least edit distance of an item to any substring, by the textbook table."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for k, x in enumerate(item):
            new.append(min(row[k] + (c != x), row[k + 1] + 1, new[k] + 1))
        row, best = new, min(best, new[-1])
    return best


@given(st.text("abc", min_size=1, max_size=12), st.text("abc", max_size=40))
def test_myers_distance(item, text):
    assert contamination.least_distance(contamination.masks(item), len(item), text, -1) == plain_distance(item, text)


def test_items_within_their_budget_are_found(frame, spark):
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 9))) for _ in range(200)]
    items = [" ".join(rnd.choice(words) for _ in range(rnd.randint(12, 40))) for _ in range(20)]
    rows, expected = [], {}
    for d in range(60):
        item = items[d % 20]
        changed = list(item)
        for _ in range(rnd.randint(0, 9)):
            changed[rnd.randrange(len(changed))] = rnd.choice("xyz")
        text = " ".join(rnd.choice(words) for _ in range(30)) + "  \n " + "".join(changed).upper() + " " + " ".join(rnd.choice(words) for _ in range(30))
        rows.append((d, text))
        expected[d] = [k for k, x in enumerate(items) if plain_distance(x, contamination.normal(text)) <= contamination.budget(x, 0.06, 50)]
    tests = spark.createDataFrame([*enumerate(items), (90, None), (91, ""), (None, "x")], "item_id long, text string")
    for block in (8 << 20, 600):
        found = contamination.find_benchmark_items(frame(rows), tests, "hits", block_bytes=block).collect()
        assert {r.doc_id: r.hits for r in found} == expected
    assert any(expected.values()) and not all(expected.values())
    odd = contamination.decontaminate(frame([*ODD, (7, f"a {items[0]} b")]), tests)
    assert odd.columns == ["doc_id", "text", "source", "kept", "size"] and odd.count() == len(ODD)
    assert contamination.decontaminate(frame([]), tests).count() == 0


def test_token_counts_equal_the_library(frame):
    odd = ["it's  naïve  ½² x\x1c y \n\n\tz  ", "a<|endoftext|>b", "日本語 テスト 123 4", " lead", "tail  ", "\r\n \r\n", "x" * 5000]
    rows = [*ODD, *((10 + i, t) for i, t in enumerate(odd))]
    library = Tokenizer.from_file(BPE)
    got = tokens.count_tokens(frame(rows), BPE, cache_size=3).collect()
    expected = sorted((str(i), len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False))) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == expected
    assert tokens.count_tokens(frame([]), BPE).count() == 0


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a\nb\\"]), st.text("<|\\/s>[INST]end\n a", max_size=30)), max_size=5))
def test_template_round_trip(turns):
    t = chat.MarkedTemplate()
    out = chat.render_spans(t, turns, frozenset(["assistant"]), 2)
    assert t.parse(out["formatted"]) == turns and out["rewritten_at"] is None
    assert [t.unescape(out["formatted"][a:b]) for a, b in out["loss_spans"]] == [x for r, x in turns if r == "assistant"]


def test_rewriting_template_is_detected():
    class Forgets:
        def render(self, turns):
            return "".join(f"<{r}>{t if i == len(turns) - 1 or r == 'user' else ''}" for i, (r, t) in enumerate(turns))

    out = chat.render_spans(Forgets(), [("user", "q"), ("assistant", "thoughts"), ("user", "r")], frozenset(["assistant"]), 2)
    assert out["rewritten_at"] == 2 and out["spans"] == []


def test_chats_with_odd_rows(spark):
    rows = [(1, 1, "assistant", None), (1, 0, "user", "hi"), (1, 1, "assistant", "b"), (None, 0, None, "x"), (2, None, "user", "y" * 200_000)]
    out = chat.read_back(chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    assert sorted((str(r.conv_id), r.n_turns, r.loss_chars) for r in out.collect()) == [("1", 3, 1), ("2", 1, 0), ("None", 1, 0)]
    empty = chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert chat.read_back(empty).count() == 0


PAGE = (
    "<html><head><title>t</title><script>if (a<b) '</p>'</script></head><body><header>Site</header><nav>menu</nav>"
    "<div class='box'>Always here {n}</div><div class='cookie-notice'>cookies</div>{body}<section id=comments><p>me too</p></section><footer>f</footer>"
)


def test_pages(spark):
    def page(body, n=""):
        return PAGE.replace("{body}", body).replace("{n}", n)

    rows = [(i, "https://a.example/x", page(f"<div><p>Own <b>te</b>xt &amp; {i}<br>more<p>second  line {i}</div>")) for i in range(12)]
    rows += [(20, "http://b.example/", page("<article><h1>Head</h1><p><b>one<br><p>two &lt;3<aside>side</aside></article>"))]
    rows += [(21, None, None), (22, "::", ""), (23, "http://c.example", "<p>" * 3000 + "deep" + "<b>" * 3000 + "er"), (20, "http://b.example/", "<div hidden>no</div>yes")]
    out = html.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    got = [(r.page_id, r.text) for r in out]
    assert (3, "Own text & 3 more\nsecond line 3") in got  # the box recurs over the host and goes
    assert (20, "Head\none\ntwo <3") in got and (20, "yes") in got and (21, "") in got and (22, "") in got and (23, "deeper") in got
    assert all(r.n_chars == len(r.text) for r in out)
    assert html.extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for k, y in enumerate(b):
            new.append(min(row[k] + (x != y), row[k + 1] + 1, new[k] + 1))
        row = new
    return row[-1]


@given(st.lists(st.text("abcd", min_size=1, max_size=10), min_size=1, max_size=6, unique=True), st.text("abcd", min_size=1, max_size=12))
def test_automaton_equals_edit_distance(terms, word):
    found = toxicity.LexiconAutomaton(dict.fromkeys(terms, False)).match(word)
    near = [(edit_distance(t, word), t) for t in terms if edit_distance(t, word) <= toxicity.edits(t, False)]
    assert found == (min(near)[::-1] if near else None)


def test_stems_and_quotation():
    f = toxicity.Finder({"vile": True, "moron": False})
    assert f.find("a vilest m0ron") == {("vile", "vilest", 0): False, ("moron", "m0ron", 1): False}
    assert f.find('she wrote "you moron" then') == {("moron", "moron", 0): True}


def test_toxicity_is_learned_from_the_training_quarters_only(frame, spark):
    rnd = random.Random(5)
    words = ["".join(rnd.choice("aeioubcdlnrst") for _ in range(rnd.randint(3, 8))) for _ in range(400)]
    rows, labels = [], []
    for d in range(900):
        bad = d % 5 == 0
        own = [rnd.choice(words) for _ in range(40)]
        if bad:
            own.insert(rnd.randrange(40), rnd.choice(["zukkon", "wexxan"]))
        rows.append((d, " ".join(own)))
        labels.append((d, int(bad)))
    marks = spark.createDataFrame([*labels, (3, None), (None, 1)], "doc_id long, toxic int")
    docs = frame([*rows, *((None if i is None else 5000 + i, t) for i, t in ODD)])
    model = toxicity.fit(docs, marks)
    assert {"zukkon", "wexxan"} <= set(model.entries)
    out = {r.doc_id: r.p for r in toxicity.score(docs, model, "p").collect()}
    assert sum((out[d] >= 0.3) == bool(y) for d, y in labels) >= 0.98 * len(labels)
    assert toxicity.drop_toxic(docs, marks).columns == docs.columns
    nothing = toxicity.fit(docs, marks.where("toxic is null"))
    assert not nothing.entries and all(r.p < 0.3 for r in toxicity.score(docs, nothing, "p").collect())
    assert toxicity.drop_toxic(frame([]), marks).count() == 0
    flipped = marks.withColumn("toxic", __import__("pyspark.sql.functions", fromlist=["when"]).when(toxicity.held_out("doc_id"), 1).otherwise(marks.toxic))
    assert toxicity.fit(docs, flipped).entries == model.entries
    assert pytest.approx(nothing.base) == toxicity.Model().base or nothing.base < 0.3
