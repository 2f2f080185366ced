"""The corpus operators on small fixtures: plain definitions, round trips and odd rows."""

import base64
import hashlib
import random
import re
import tracemalloc

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from touchtrail.llm import (
    bpe,
    chat,
    common,
    decontaminate,
    language,
    main_text,
    minhash,
    near_vectors,
    passages,
    quality,
    url_filter,
)
from touchtrail.llm.queries import LLM_ORACLE, LLM_QUERIES, URL_RULES

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, node int"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def texts():
    draw = random.Random(4)
    words = ["stone", "river", "Élan", "cloud", "seven", "maple", "tide", "owl", "amber", "north"]
    base = " ".join(draw.choice(words) + str(draw.randrange(60)) for _ in range(120))
    near = base.replace("stone", "stones", 2)
    tail = " ".join(draw.choice(words) + str(draw.randrange(60)) for _ in range(90))
    odd = ["", None, " \n\t ", "one", "one two three", "\x00\x1c é 日本 <|end|>", "aaaa" * 400, "!!"]
    return [base, near, base, "x" * 20 + base[300:500] + tail, tail, *odd, base + " " + tail * 40]


@pytest.fixture(scope="module")
def docs(spark):
    common.importable(spark)
    rows = [(n, t, None, None, None, 1.0, n) for n, t in enumerate(texts())]
    return spark.createDataFrame([*rows, rows[3], (None, "one", "en", "s", 3, None, None)], DOCS)


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.where("false")


def test_bpe_equals_the_library_and_decodes(docs, nothing):
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    given = {n: t or "" for n, t in enumerate(texts())}
    out = bpe.encode_texts(docs, RANKS, public_tokenizers.PATTERN)
    for row in out.where("doc_id is not null").collect():
        ids = library.encode_ordinary(given[row.doc_id])
        assert row.ids == ids and row.n_tokens == len(ids)
        assert row.decoded_sha256 == hashlib.sha256(given[row.doc_id].encode()).hexdigest()
    assert bpe.encode_texts(nothing, RANKS, public_tokenizers.PATTERN).count() == 0


def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lower)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[n : n + 5]) for n in range(len(words) - 4)}


def test_minhash_equals_all_pairs(docs, nothing):
    sets = [shingles(t) for t in texts()]
    root = list(range(len(sets)))
    for _ in sets:
        for a, one in enumerate(sets):
            for b, two in enumerate(sets):
                if one and two and 100 * len(one & two) >= 75 * len(one | two):
                    root[a] = root[b] = min(root[a], root[b])
    out = minhash.near_duplicates(docs).where("doc_id is not null").collect()
    assert len(out) == len(sets) + 1
    for row in out:
        assert row.n_shingles == len(sets[row.doc_id])
        assert row.component_id == root[row.doc_id] and row.kept == (row.doc_id == root[row.doc_id])
    assert minhash.near_duplicates(nothing).count() == 0


def test_blocks_of_a_family_are_spread_over_tasks(spark, docs):
    blocks = [(low, high) for low in range(12) for high in range(low, 12)]
    rows = [(1, low, high, n) for low, high in blocks for n in range(20)]
    of_family = spark.createDataFrame(rows, "family long, low int, high int, node long")
    dealt = of_family.repartition(8, "family")

    def where(table):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        return table.slice(0, 1).select(["family"]).append_column("part", [[part]]).append_column(
            "rows", [[table.num_rows]]
        )

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        seen = minhash._block_pairs(dealt).applyInArrow(where, "family long, part long, rows long").collect()
        plain = dealt.groupBy("family", "low", "high").applyInArrow(where, "family long, part long, rows long")
        assert len({r.part for r in plain.collect()}) == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(seen) == len(blocks) and {r.rows for r in seen} == {20}
    assert len({r.part for r in seen}) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_short_lived_tables_go_and_lasting_ones_stay(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "scratch_dir", lambda _, label: f"{tmp_path}/{label}")
    rows = spark.range(3)
    with pytest.raises(ZeroDivisionError), common.short_lived(spark):
        with common.short_lived(spark):
            common.written(rows, "inner")
            outer = common.written(rows, "outer", lasting=True)
        assert not (tmp_path / "inner").exists() and outer.count() == 3
        kept = common.written(outer, "kept", lasting=True)
        raise ZeroDivisionError
    assert not (tmp_path / "outer").exists() and kept.count() == 3
    assert common.written(rows, "plain").count() == 3


@pytest.mark.parametrize("pieces", [2000, 2])
def test_passages_equal_the_plain_definition(docs, nothing, monkeypatch, pieces):
    monkeypatch.setattr(passages, "BLOCK_PIECES", pieces)
    seen, expected = set(), {}
    for n, text in enumerate(texts()):
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for at in range(len(data) - 99):
            if data[at : at + 100] in seen:
                gone[at : at + 100] = True
            seen.add(data[at : at + 100])
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(b for b, g in zip(data, gone) if not g)
        expected[n] = (len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    out = passages.passage_digests(docs).where("doc_id is not null").collect()
    assert len(out) == len(expected) + 1
    for row in out:
        assert tuple(row)[1:] == expected[row.doc_id], row.doc_id
    assert passages.passage_digests(nothing).count() == 0
    assert passages.remove_passages(docs).columns == docs.columns


def test_column_index_sorts_all_suffixes():
    draw = random.Random(1)
    for _ in range(50):
        strings = [bytes(draw.choices(b"ab\x00", k=draw.randrange(9))) for _ in range(5)]
        offsets = np.cumsum([0, *map(len, strings)])
        found = passages.column_index(np.frombuffer(b"".join(strings), np.uint8), offsets)
        suffixes = [strings[s][len(strings[s]) - n :] for s, n in zip(*map(np.ndarray.tolist, found[:2]))]
        assert suffixes == sorted(suffixes)
        for one, two, common_prefix in zip(suffixes, suffixes[1:], found[2][1:].tolist()):
            equal = [a == b for a, b in zip(one, two)]
            assert common_prefix == (equal.index(False) if False in equal else len(equal))


def test_vectors_equal_all_pairs(spark, docs, monkeypatch):
    monkeypatch.setattr(near_vectors, "MEMBERS_PER_CELL", 20)
    monkeypatch.setattr(near_vectors, "BLOCK", 16)
    draw = np.random.default_rng(5)
    centre = draw.normal(size=(12, 8))
    rows = (centre[draw.integers(0, 12, 150)] + 0.25 * draw.normal(size=(150, 8))).tolist()
    rows += [rows[0], rows[1], None, [0.0] * 8, [float("nan")] * 8, [None] * 8, [1.0, 2.0], []]
    table = spark.createDataFrame(
        [(n, v, 0) for n, v in enumerate(rows)], "vec_id long, embedding array<double>, member int"
    )
    good = {n: np.array(v) / np.linalg.norm(v) for n, v in enumerate(rows[:152])}
    links = {a: {b for b in good if b != a and good[a] @ good[b] >= 0.95} for a in good}
    root = {a: a for a in range(len(rows))}
    for _ in good:
        for a, others in links.items():
            root[a] = min([root[a], *(root[b] for b in others)])
    for row in near_vectors.near_duplicates(table).collect():
        assert row.n_links == len(links.get(row.vec_id, ()))
        assert row.component_id == root[row.vec_id]
    assert near_vectors.near_duplicates(table.where("false")).count() == 0


def test_rules_and_walks(spark, docs):
    rows = [
        (1, "http://WWW.Example.com/en/x?q", None),
        (2, "http://a.example.com/en/", '<a href="http://good.org/">'),
        (3, "http://b.net/es/1", ""),
        (4, "http://b.net/es/2", ""),
        (5, "http://b.net/de/1", ""),
        (6, "nothing", "x"),
        (7, None, None),
        (8, "http://friend.org/", '<a href="http://b.net/es/1">'),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = {r.page_id: r for r in url_filter.judge_urls(pages, URL_RULES).collect()}
    assert [out[n].rule for n in range(1, 7)] == [
        "www.example.com/en/", "example.com/en/", "net/es/", "net/es/", None, None,
    ]
    assert (out[1].host, out[1].path) == ("www.example.com", "/en/x")
    assert out[5].verdict == "block" and out[6].verdict == out[7].verdict == "allow"
    assert out[8].verdict == "block"  # its only link goes to a blocked host
    assert url_filter.judge_urls(pages.where("false"), URL_RULES).count() == 0


def plain_verdicts(pages, links):
    """Verdicts of hosts without a rule, by both walks as dense matrices run to their ends."""
    hosts = sorted({h for h, _ in pages} | {h for pair in links for h in pair})
    place = {h: n for n, h in enumerate(hosts)}
    size, count = len(hosts), np.zeros(len(hosts))
    seeds = {"allow": np.zeros(size), "block": np.zeros(size)}
    for host, verdict in pages:
        count[place[host]] += 1
        if verdict:
            seeds[verdict][place[host]] += 1
    weight = np.zeros((size, size))
    for (src, dst), n in links.items():
        weight[place[src], place[dst]] = n
    mass = {}
    for kind, steps in (("allow", weight), ("block", weight.T)):
        out = steps.sum(axis=1)
        start = seeds[kind] / max(seeds[kind].sum(), 1)
        now = start.copy()
        for _ in range(600):
            walked = (np.divide(now, out, where=out > 0, out=np.zeros(size)) @ steps) if size else now
            now = 0.85 * walked + start * (0.15 + 0.85 * now[out == 0].sum())
        mass[kind] = now * seeds[kind].sum()
    out = {}
    for host in {h for h, _ in pages}:
        n = place[host]
        distrust = max(seeds["block"][n] / count[n], mass["block"][n] / count[n])
        out[host] = "block" if distrust >= 0.5 and distrust > mass["allow"][n] / count[n] else "allow"
    return out


def test_verdicts_equal_dense_walks_on_random_graphs(spark, docs):
    blocked = 0
    for seed in (1,):
        draw = random.Random(seed)
        hosts = [f"h{n}.{draw.choice(['org', 'com', 'net', 'net'])}" for n in range(40)]
        rows, pages, links = [], [], {}
        for n in range(150):
            host = draw.choice(hosts)
            path = draw.choice(["/es/x", "/de/x", "/fr/y", "/"])
            to = {h for h in draw.sample(hosts, draw.randrange(4))}
            html = " ".join(f'<a href="https://{h}/p">x</a>' for h in [*to, *to])
            rows.append((n, f"http://{host}{path}", html, "x", 1))
            verdict = None
            if host.endswith(".com"):
                verdict = "allow"
            elif host.endswith(".net") and path[:4] in ("/es/", "/fr/"):
                verdict = "block"
            pages.append((host, verdict))
            for other in to - {host}:
                links[host, other] = links.get((host, other), 0) + 1
        table = spark.createDataFrame([*rows, rows[0]], "page_id long, url string, html string, host string, trust int")
        pages.append(pages[0])
        for other in {h for h in re.findall("https://([^/]+)/p", rows[0][2])} - {pages[0][0]}:
            links[pages[0][0], other] += 1
        expected = plain_verdicts(pages, links)
        out = url_filter.judge_urls(table, URL_RULES).collect()
        assert len(out) == 151
        for row in out:
            if row.rule is None:
                assert row.verdict == expected[row.host], (seed, row)
                blocked += row.verdict == "block"
        con = duckdb.connect()
        con.register("pages", table.toPandas())
        assert sorted(map(str, con.sql(LLM_ORACLE["op3_url_filter"]).fetchall())) == sorted(
            str(tuple(row)) for row in out
        )
    assert blocked > 0


def test_walks_reach_the_end_of_a_long_chain(spark, docs, monkeypatch):
    monkeypatch.setattr(url_filter, "TOLERANCE", 0.05)
    names = [f"h{n}.org" for n in range(33)] + ["b.net/es/0"]
    rows = [(n, f"http://b.net/es/{n}", "") for n in range(3000)]
    for n, (name, to) in enumerate(zip(names, names[1:])):
        rows.append((3000 + n, f"http://{name}/", f'<a href="//{to}">'))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = url_filter.judge_urls(pages, URL_RULES).where("page_id >= 3000").collect()
    assert len(out) == 33 and {r.verdict for r in out} == {"block"}


def test_chat_reads_back_and_validates(spark, docs):
    rows = [
        (1, 0, "user", "</s>[INST] &lt; a|b [/INST]"),
        (1, 1, "assistant", "<|end|>\n&amp;"),
        (2, 0, "assistant", None),
        (3, None, None, "x"),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = chat.format_conversations(table)
    back = {r.conv_id: r for r in formatted.select("*", chat.read_turns(F.col("formatted")).alias("t"), chat.loss_text(F.col("segments")).alias("l")).collect()}
    assert [tuple(t) for t in back[1].t] == [r[2:] for r in rows[:2]]
    assert back[1].l == "<|end|>\n&amp;" and back[1].valid
    assert not back[2].valid and not back[3].valid and [tuple(t) for t in back[3].t] == [("", "x")]
    assert chat.format_conversations(table.where("false")).count() == 0


def test_leaks_also_with_other_slots(spark, docs):
    item = "Anna walks 12 miles in 3 hours while Ben walks 9 miles in the same time how far apart are they"
    other = item.replace("Anna", "Carla").replace("12", "20").replace("Ben", "David")
    mixed = item.replace("12", "20")
    rows = [(1, "so " + item + " now"), (2, "then " + other), (3, "clean words only here"), (4, None), (5, mixed.upper())]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (8, None), (9, "tiny item")], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.view for r in decontaminate.leaks(table, bench).collect()}
    assert found[1, 7] == "plain" and found[2, 7] == "template"
    assert not {d for d, _ in found} & {3, 4}
    kept = decontaminate.without_leaks(table, bench)
    assert {3, 4} <= {r.doc_id for r in kept.collect()} and kept.columns == table.columns
    assert decontaminate.leaks(table, bench.where("false")).count() == 0


def test_each_occurrence_of_a_leak_is_judged_on_its_own(spark, docs):
    item = "Anna buys 12 apples and Ben buys 9 pears while Carla sells 30 plums to David for 7 coins"
    olds = ["Anna", "12", "Ben", "9", "Carla", "30", "David", "7"]
    draws = (["Emma", "21", "Fred", "8", "Gina", "44", "Hugo", "5"],
             ["Ida", "33", "Jack", "6", "Kate", "51", "Leo", "2"],
             ["Mia", "17", "Nils", "4", "Olga", "60", "Paul", "3"])
    variants = []
    for news in draws:
        turned = dict(zip(olds, news))
        variants.append(" ".join(turned.get(word, word) for word in item.split()))
    added = variants[1].replace("pears while", "pears one fine day while")
    twice = "Ann has 4 red nuts and Ann has 4 big nuts and Ann has 4 old nuts for sale"
    # One value of the item turns into several within one copy.
    spoilt = "Bob has 5 red nuts and Cid has 6 big nuts and Dan has 7 old nuts for sale"
    rows = [
        (1, variants[0]), (2, " and then ".join(variants[:2])), (3, " ".join(variants)),
        (4, f"{variants[0]} stop {added}"), (5, "buys 3 apples and Zoe buys 4 pears " * 200 + variants[2]),
        (6, spoilt), (7, "Bob has 5 red nuts and Bob has 5 big nuts and Bob has 5 old nuts for sale"),
    ]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, twice)], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in decontaminate.leaks(table, bench).collect()}
    assert {(n, 1) for n in range(1, 6)} | {(7, 2)} == set(found)
    assert all(r.view == "template" for r in found.values())


def test_leaks_with_many_and_compound_slots(spark, docs):
    trip = (
        "Ben drives 12 miles on Monday and pays 3 dollars for fuel then Carla drives 1,200 miles on "
        "Friday and pays 9 dollars while the price of fuel stays at 4 dollars for each of them"
    )
    other = trip.replace("Ben", "Mary Ann").replace("12 miles", "2.5 miles").replace("Carla", "Jo Lee")
    other = other.replace("1,200", "7").replace("3 dollars", "1,000.50 dollars")
    room = "the floor of a room has 40 square feet and needs 12 pounds of paint to cover all of it"
    rows = [
        (1, "so what is 5 + 61 - 8 x 9 then"), (2, other), (3, f"{other} and {trip}"),
        (4, trip.upper().replace("12", "85").replace("1,200", "3.75").replace("9", "6")),
        (5, room.replace("40 square feet", "9.5 meters").replace("12 pounds", "3 fluid ounces")),
        (6, "What is 12 to 7 or 3 x 4"), (7, "is 1 2 3 x"),
        (8, "5 9 2 7 1 4 " * 300 + "Ann Bob Cid " * 300),
    ]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    items = [(1, "What is 12 + 7 - 3 x 4"), (2, trip), (3, room), (4, "12 7 3 9 8"), (5, "Add 1,200 to 2.5 now")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.view for r in decontaminate.leaks(table, bench).collect()}
    assert {(1, 1), (2, 2), (3, 2), (4, 2), (5, 3)} == set(found)
    more = spark.createDataFrame([(1, "please add 31 to 4,000 now")], "doc_id long, text string")
    assert [r.item_id for r in decontaminate.leaks(more, bench).collect()] == [5]


def test_main_text():
    page = (
        "<html><head><title>t</title><script>var a='</p>';</script></head><body><nav>menu</nav>"
        "<div class='cookie notice'>c</div><article><h1>A &amp; B</h1><p>one<b>two<br>three<p>four"
        "<div id=comments>no</div></article><footer>f</footer></body>"
    )
    assert main_text.read_page(page)[0] == "A & B onetwo three four"
    assert main_text.read_page("")[0] == "" and main_text.read_page("<p>a < b")[0] == "a < b"


def test_odd_markup_loses_no_text():
    read = lambda page: main_text.read_page(page)[0]
    assert read("<p data-x=it's>Hello there</p><p>don't stop</p><p>tail</p>") == "Hello there don't stop tail"
    assert read('<p>said</p><p title="a>Hello') == "said"
    assert read("<p a='>' b=\">\" c = > x</p></3>y<!-- > -->z<!-->w<?p?>v<!x>u") == "x yzwvu"
    assert read("<p class>one</p><p =a>two</p><br/><p/>three<img src=a/b>four</p><") == "one two threefour <"
    assert read("<script>a</script x>b<style>c</style><title>d</title  >e<textarea>f") == "be"
    assert read("a</p></div></b>b<b></i>c</b>d") == "a bcd"
    assert read("<article>x<div hidden>n</div><div aria-hidden='TRUE'>n</div><div role=navigation>n</div>") == "x"


def test_long_pages_of_any_markup_are_read_in_time():
    import time

    size = 5_000_000
    for piece in ("<a ", "<div>", "<div class=ad>", "<p x=\"", "</div>", "<!--", "<", "</", "<script>", "<p>x",
                  "<div>x</div>", "<div class=comments><p>", "&amp;", "<li a=b c='d'>e", "<script></script ",
                  "<table><tr><td>", "<x y=z/>", "= ", "<b></p>", "<div></b>"):
        # The two that once took time with the square of the length in full, the others shorter.
        page = piece * ((size if piece in ("<a ", "<div>") else size // 5) // len(piece))
        start = time.process_time()
        main_text.read_page(f"<body><article><p>one</p>{page}")
        assert time.process_time() - start < 10 * 4, piece
    nested = "<div>" * 200_000 + "x" + "</div>" * 200_000
    start = time.process_time()
    assert len(main_text.read_page(nested)[1]) == 200_000
    assert time.process_time() - start < 20


def test_reader_comments_and_notices_in_an_article():
    said = "<h1>A</h1><p>one two three four five</p><p>six</p>"
    reply = "<div class=post><b>Eve</b><p>me too</p></div>"
    for name in ("discussion", "replies", "responses", "user_comments", "reader-comments", "comments"):
        for child in (reply, "<li>me too</li>", "<article>me too</article>"):
            box = f"<div class='{name}'><h2>What others say</h2>{child}{child}</div>"
            assert main_text.read_page(f"<article>{said}{box}</article>")[0] == "A one two three four five six"
    paper = f"<article>{said}<section class=discussion><h2>Discussion</h2><p>seven</p><p>eight</p></section></article>"
    assert main_text.read_page(paper)[0].endswith("six Discussion seven eight")
    for name in ("notice", "banner", "site-notice"):
        box = f"<div class='{name}'>We use cookies</div>"
        assert main_text.read_page(f"<article>{box}{said}</article>")[0] == "A one two three four five six"
    assert main_text.read_page(f"<article>{said}<p class=notice>own note</p></article>")[0].endswith("own note")


def test_equal_elements_have_equal_hashes():
    box = "<div class=x><ul><li>a<li>b</ul><p>c</p></div>"
    one = main_text.read_page(f"<body>{box}<p>one</p></body>")[1]
    two = main_text.read_page(f"<body><main><b>two</b>{box}</main></body>")[1]
    other = main_text.read_page(f"<body>{box.replace('<li>b', '<li>d')}<p>three</p></body>")[1]
    assert len(set(one) & set(two)) == 3
    # The changed list and what is around it differ, the paragraph beside it does not.
    assert len(set(one) & set(other)) == 1


def test_template_counts_equal_a_plain_counter(spark, docs):
    draw = random.Random(12)
    boxes = [f"<div class=b{n}><p>box {n}</p></div>" for n in range(8)]
    pages = []
    for n in range(70):
        parts = draw.sample(boxes, draw.randrange(4)) + [f"<p>{p}</p>" for p in paragraphs(n % 50, 3)]
        draw.shuffle(parts)
        host = "abc"[0 if n < 30 else 1 if n < 60 else 2]
        pages.append((n, f"http://{host}.org/{n}", f"<body>{''.join(parts)}</body>"))
    pages += [(70, None, None), (71, "nowhere", ""), (72, None, "<p>x</p>"), pages[3]]
    schema = "page_id long, url string, html string, text string, host long, page string, _html int"
    table = spark.createDataFrame([(*p, "t", 1, "p", 2) for p in pages], schema)
    seen = {}
    for _, url, html in pages:
        host = (url or "").partition("://")[2].partition("/")[0]
        text, found = main_text.read_page(html or "")
        for number, (group, _) in found.items():
            seen.setdefault((host, number, group), set()).add(text)
    expected = []
    for page_id, url, html in pages:
        host = (url or "").partition("://")[2].partition("/")[0]
        sizes = len({t for (h, _, _), texts in seen.items() for t in texts if h == host})
        found = main_text.read_page(html or "")[1]
        gone = {
            n for n, (group, used) in found.items()
            if (group and used and len(seen[host, n, True]) >= 3)
            or any(
                len(seen.get((host, n, kind), ())) >= max(20, sizes / 2) for kind in (True, False)
            )
        }
        expected.append((page_id, main_text.read_page(html or "", frozenset(gone))[0]))
    got = main_text.extract(table)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.page_id, r.text) for r in got.collect()) == sorted(expected)
    assert all(r.n_chars == len(r.text) for r in got.collect())
    assert any("box" in t for _, t in expected) and sum("box" in t for _, t in expected) < 60
    assert main_text.extract(table.where("false")).count() == 0


def paragraphs(n, count=5):
    draw = random.Random(n)
    return [" ".join(f"w{draw.randrange(10**6)}" for _ in range(12)) for _ in range(count)]


def main_texts(spark, pages):
    """Texts by row for (url, html) pages, which must come in the order of page_id."""
    rows = [(n, *page) for n, page in enumerate(pages)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    return [r.text for r in main_text.extract(table).orderBy("page_id").collect()]


def test_copies_do_not_make_an_article_a_template(spark, docs):
    def page(said, extra=""):
        body = "".join(f"<p>{p}</p>" for p in said)
        return f"<body>{extra}<article>{body}<p>Terms apply to all readers.</p></article></body>"

    expected, pages = [], []
    for n in range(40):  # equal articles next to other adverts
        pages.append((f"http://a.org/copy?utm={n}", page(paragraphs(0), f"<div>advert {n}</div>")))
    for n in range(30):
        pages.append((f"http://a.org/{n}", page(paragraphs(n + 1))))
    expected += [" ".join(paragraphs(0))] * 40 + [" ".join(paragraphs(n + 1)) for n in range(30)]
    for n in range(30):  # articles that differ in their last paragraph
        said = paragraphs(99)[:4] + paragraphs(200 + n)[:1]
        pages.append((f"http://b.org/{n}", page(said)))
        expected.append(" ".join(said) + " Terms apply to all readers.")
    assert main_texts(spark, pages) == expected


def test_class_names_of_layout_and_text_stay():
    said = "<article><h1>A</h1><p>one two three</p></article>"
    for name in ("content no-sidebar", "wrapper has-sidebar", "sticky-header", "sidebar", "page menu"):
        assert main_text.read_page(f"<body><div class='{name}'>{said}</div>")[0] == "A one two three"
        bare = f"<body><div id='{name}'><p>one two three</p></div><p>four</p></body>"
        assert main_text.read_page(bare)[0] == "one two three four"
    held = (
        "<article><div class='article-header'><h1>A</h1></div><div class=related-work>B</div>"
        "<p class=notice>C</p><div class='share-buttons'>x</div><p class='x ad-slot'>x</p>"
        "<div class=newsletter>x</div>D</article><div class=related><article>x</article></div>"
    )
    assert main_text.read_page(held)[0] == "A B C D"
    outside = "<body><div class=site-nav>x</div><div id=cookie-banner>x</div><p>one two three</body>"
    assert main_text.read_page(outside)[0] == "one two three"


def test_repeated_groups_go_without_telling_names(spark, docs):
    menu = "<div class=x1><ul><li>Home</li><li>Goods</li></ul></div>"
    foot = "<div class=x9><p>All rights with the site</p></div>"
    pages, expected = [], []
    for n in range(3):  # a small host
        said = paragraphs(300 + n)
        body = "".join(f"<p>{p}</p>" for p in said) + "<p>Under a free licence.</p>"
        pages.append((f"http://s.org/{n}", f"<body>{menu}<div class=c>{body}</div>{foot}</body>"))
        expected.append(" ".join(said) + " Under a free licence.")
    for n in range(60):  # a menu of one section of a larger one, and a note within its articles
        said = paragraphs(400 + n)
        body = "".join(f"<p>{p}</p>" for p in said)
        if n % 3:
            pages.append((f"http://l.org/{n}", f"<body>{menu if n < 9 else ''}{body}</body>"))
        else:
            note = "<section class=q><p>Ask us for more</p></section>" if n < 12 else ""
            pages.append((f"http://l.org/{n}", f"<body><article>{body}{note}</article></body>"))
        expected.append(" ".join(said))
    for n in range(4):  # copies without an article element, next to other adverts
        said = "".join(f"<div class=k{k}><p>{p}</p></div>" for k, p in enumerate(paragraphs(500)))
        pages.append((f"http://t.org/{n}", f"<body>{said}<div class=z>buy {n}</div></body>"))
        expected.append(" ".join(paragraphs(500)) + f" buy {n}")
    pages.append(("http://u.org/", f"<body>{menu}<p>one</p></body>"))
    expected.append("Home Goods one")
    assert main_texts(spark, pages) == expected


def test_language_and_quality_hold_out(spark, docs, nothing):
    for name, least in (("op10_language", 0.95), ("op8_quality", 0.95)):
        out = LLM_QUERIES[name](spark, "/root/testdata/sf0.01")
        sf = "/root/testdata/sf0.01/"
        if name == "op10_language":
            truth = spark.read.parquet(sf + "documents.parquet").select("doc_id", "lang")
            right = F.col("lang") == F.col("lang_pred")
        else:
            truth = spark.read.parquet(sf + "labels.parquet").select("doc_id", "quality")
            right = F.col("quality") == F.col("predicted")
        held = out.where("held_out").join(truth, "doc_id")
        assert held.agg(F.avg(right.cast("double"))).first()[0] >= least
    odd = language.predict(docs).collect()
    assert len(odd) == docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert language.predict(nothing).count() == 0
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.score_quality(docs, none).collect()} == {0.5}


def test_pipeline_on_the_small_tables(spark, docs):
    sf = "/root/testdata/sf0.001"
    out = corpus_pipeline.run(spark, sf)
    given = common.read_table(spark, sf, "documents")
    assert 0 < out.count() <= given.count() and out.join(given, "doc_id", "left_anti").isEmpty()
    assert out.select("doc_id").distinct().count() == out.count()


def test_pipeline_equals_the_plain_stages(spark, docs, tmp_path):
    item = "Anna walks 12 miles in 3 hours while Ben walks 9 miles in the same time how far apart are they"
    other = item.replace("Anna", "Carla").replace("12", "20").replace("Ben", "David")
    said = [" ".join(paragraphs(n)) for n in (600, 601, 602)]
    given = [t for t in texts() if t is None or len(t) != 1600]
    given += [said[0], f"{said[1]} {item}", f"{other} {said[2]}", "12 34, 56!", "日本", said[0] + " end"]
    leaked = {len(given) - 5, len(given) - 4}
    spark.createDataFrame(
        [(n, t, None, None, None, 1.0, n) for n, t in enumerate(given)], DOCS
    ).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    kept, seen, expected = [], set(), {}
    for n, text in enumerate(given):
        if not any(c.isalpha() for c in text or ""):
            continue
        near = [shingles(given[m]) for m in kept]
        own = shingles(text)
        if any(100 * len(own & s) >= 75 * len(own | s) for s in near):
            continue
        kept.append(n)
    for n in kept:
        data = given[n].encode()
        gone = np.zeros(len(data), bool)
        for at in range(len(data) - 99):
            if data[at : at + 100] in seen:
                gone[at : at + 100] = True
            seen.add(data[at : at + 100])
        if n not in leaked:
            left = bytes(b for b, g in zip(data, gone) if not g)
            expected[n] = hashlib.sha256(left).hexdigest()
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id: r.decoded_sha256 for r in out} == expected and len(out) == len(expected)
    assert 0 < len(expected) < len(kept) < len(given)


def test_stages_bound_what_a_worker_gets(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    docs = spark.range(3_000, numPartitions=1).selectExpr(
        "id AS doc_id", "repeat('long ', 2000) AS text"
    )

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    try:
        corpus_pipeline.tokens(spark, docs, "")
        largest = max(r.n for r in docs.mapInArrow(sizes, "n long").collect())
        # A batch ends with the row that reaches the bound.
        assert largest < (4 << 20) + 20_000
    finally:
        spark.conf.set(key, before)


def test_arrays_of_windows_do_not_grow_with_a_batch():
    draw = random.Random(12)
    words = [f"word{n}" for n in range(900)]
    batch = pa.array([" ".join(draw.choices(words, k=400)) for _ in range(1_000)])
    assert batch.nbytes > 2_500_000
    tracemalloc.start()
    try:
        for _ in decontaminate._windows(batch, (5,), False, (5, 6)):
            pass
        assert tracemalloc.get_traced_memory()[1] < 50_000_000
    finally:
        tracemalloc.stop()


def held_items(spark, texts, items):
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return sorted((r.doc_id, r.item_id) for r in decontaminate.leaks(table, bench).collect())


def test_clean_sentences_of_like_shape_are_no_leaks(spark, docs):
    items = ["What is the capital of France", "Who wrote the book about Anna and when"]
    clean = [
        "Paris is the capital of France and it is large",
        "we know that Berlin is the capital of Germany today",
        "Rome is the capital of Italy. Madrid is the capital of Spain.",
        "What is the capital",
        "Nobody wrote the book about Carla and then left",
    ]
    assert held_items(spark, clean, items) == []
    assert held_items(spark, ["So: what is the capital of France?"], items) == [(0, 0)]


def test_names_of_any_script_are_slots(spark, docs):
    items = [
        "Øystein bought 12 apples for Žofie and then Øystein gave 3 of them back to Žofie at home",
        "Вчера Иван купил 12 яблок для Ольга и потом Иван отдал 3 из них назад Ольга дома",
    ]
    texts = [
        "Łukasz bought 21 apples for Šimon and then Łukasz gave 5 of them back to Šimon at home",
        "вчера Пётр купил 40 яблок для Мария и потом Пётр отдал 7 из них назад Мария дома",
        items[0].upper(),
        items[1].upper(),
    ]
    assert held_items(spark, texts, items) == [(0, 0), (1, 1), (2, 0), (3, 1)]


def test_items_of_one_shape_are_one_class(spark, docs):
    shape = "a farmer sold {} apples at the market to {} and later {} more to the same customer for cash"
    items = [shape.format(n, name, n + 7) for n in range(10, 40) for name in ("him", "her")]
    items += [shape.format(5, "him", 5), "another item that has nothing to do with any of the others"]
    texts = ["so " + shape.format(800 + n, "him", 2 * n) for n in range(50)]
    texts += [items[7], items[58] + " and " + items[4], shape.format(77, "him", 77)]
    found = held_items(spark, texts, items)
    # One row for a variant, the items themselves where they stand word by word.
    variants = [(n, 0) for n in range(50)]
    assert [pair for pair in found if pair[0] < 50 and pair[1] == 0] == variants
    assert {(50, 7), (51, 4), (51, 58)} <= set(found)
    # Equal numbers in both places are a variant of the item that has them equal, and of others.
    assert (52, 60) in found
    assert len(found) <= 2 * 50 + 8
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    classes = {r.item_id: r for r in decontaminate.item_classes(bench).collect()}
    assert {classes[n].class_id for n in range(0, 60, 2)} == {0}
    assert {classes[n].class_id for n in range(1, 60, 2)} == {1}
    assert classes[60].class_id == 60 and classes[0].class_items == 30


def plain_tokens(text):
    """Words with whether they open a sentence and whether they are capitalised, by the rules."""
    out, opens = [], True
    for match in re.finditer(r"[^\W_]+|[.!?:;\n\"()]", text or ""):
        word = match.group()
        if word.isalnum():
            out.append((word.lower(), opens, word[0].isupper()))
            opens = False
        else:
            opens = True
    return out


def plain_windows(text):
    """Windows of five as (plain, template, slot values) by the definition."""
    words = plain_tokens(text)
    within = {w for w, opens, capital in words if capital and not opens}
    kinds = []
    for word, opens, capital in words:
        number = re.fullmatch("[0-9]+", word)
        unit = word in decontaminate.UNITS
        name = capital and (not opens or word in within) and not number
        kinds.append("#" if number else "%" if unit else "@" if name else "")
    out = []
    for n in range(len(words) - 4):
        five, kind = [w for w, _, _ in words[n : n + 5]], kinds[n : n + 5]
        usable = any(kind) and sum(not k for k in kind) >= 2
        shape = tuple(k or w for k, w in zip(kind, five)) if usable else None
        out.append((tuple(five), shape, tuple(w for k, w in zip(kind, five) if k)))
    evidence = sum(k in ("", "#") for k in kinds)
    return out, evidence


def plain_whole_document_leak(text, item):
    """The reading by single words over a whole document, without occurrences."""
    ours, _ = plain_windows(text)
    theirs, evidence = plain_windows(item)
    if not theirs:
        return False
    plain, shapes = {p for p, _, _ in ours}, {}
    for _, shape, values in ours:
        if shape and evidence >= decontaminate.LEAST_EVIDENCE:
            shapes.setdefault(shape, []).append(values)
    literal = sum(p in plain for p, _, _ in theirs)
    matched = sum(p in plain or (s in shapes) for p, s, _ in theirs)
    if matched < 0.75 * len(theirs):
        return False
    if literal >= 0.75 * len(theirs):
        return True
    turned = {}
    for _, shape, values in theirs:
        for other in shapes.get(shape, ()) if shape else ():
            for old, new in zip(values, other):
                turned.setdefault(old, []).append(new)
    tops = sum(max(map(news.count, set(news))) for news in turned.values())
    return tops >= 0.75 * sum(map(len, turned.values()))


def test_leaks_equal_the_plain_definition_on_random_items(spark, docs):
    draw = random.Random(77)
    words = "the of and to sold red blue market paid apples trains went over under many then while".split()
    names, units = ["Anna", "Ben", "Çağla", "Иван", "Łukasz"], ["miles", "dollars", "kg"]

    def sentence(n):
        out = []
        for _ in range(n):
            kind = draw.random()
            out.append(
                str(draw.randrange(99)) if kind < 0.15 else draw.choice(names) if kind < 0.3
                else draw.choice(units) if kind < 0.35 else draw.choice(words)
            )
        return " ".join(out)

    def varied(text, share):
        return " ".join(
            str(draw.randrange(99)) if w.isdigit() and draw.random() < share
            else draw.choice(names) if w in names and draw.random() < share
            else draw.choice(words) if draw.random() < share / 8 else w
            for w in text.split()
        )

    items = [sentence(draw.randrange(5, 30)) for _ in range(25)]
    texts = [sentence(40) for _ in range(20)] + [None, ""]
    for item in items:
        for share in (0.0, 0.3, 1.0):
            texts.append(f"{sentence(6)}. {varied(item, share)} {sentence(5)}")
    found = set(held_items(spark, texts, items))
    expected = {
        (d, n) for d, text in enumerate(texts) for n, item in enumerate(items)
        if plain_whole_document_leak(text, item)
    }
    # Occurrences and compound slots find more, never less, and nothing that shares few windows.
    assert expected <= found and len(expected) >= 40
    for d, n in found - expected:
        ours, theirs = plain_windows(texts[d])[0], plain_windows(items[n])[0]
        shapes = {s for _, s, _ in ours if s} | {p for p, _, _ in ours}
        assert sum(p in shapes or s in shapes for p, s, _ in theirs) >= 0.4 * len(theirs)
    assert not {d for d, _ in found} & {20, 21}


def plain_quadratic_scores(rows, texts):
    """Scores by the formula: rows are (statistics, label), covariances inverted as they are."""
    every = np.array([x for x, _ in rows])
    moments = {}
    for label in (0, 1):
        own = every[[n for n, (_, given) in enumerate(rows) if given == label]]
        moments[label] = (len(own), own.mean(axis=0), np.cov(own.T, bias=True))
    total = sum(n for n, _, _ in moments.values())
    pooled = sum(n * cov for n, _, cov in moments.values()) / total
    out = []
    for x in texts:
        density = {}
        for label, (n, mean, cov) in moments.items():
            cov = 0.8 * cov + 0.2 * pooled
            cov = 0.8 * cov + 0.2 * np.diag(np.diag(cov)) + 1e-2 * np.eye(len(cov))
            distance = (x - mean) @ np.linalg.inv(cov) @ (x - mean)
            density[label] = np.log(n / total) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * distance
        out.append(1 / (1 + np.exp(-np.clip((density[1] - density[0]) / 2, -40, 40))))
    return out


def test_quality_scores_equal_the_formula(spark, docs, nothing):
    import zlib

    import pyarrow as pa

    draw = random.Random(31)
    said = []
    for n in range(120):
        good = n % 2
        words = [draw.choice(["river", "stone", "and", "the", "maple,", "Élan."]) for _ in range(draw.randrange(1, 80))]
        said.append(" ".join(words) if good else " ".join(w + draw.choice(["###", "12", "!!", ""]) for w in words) + "\n" * 3)
    said += [None, "", "x" * 300_000, said[0]]
    ids = [*range(len(said) - 1), 0]
    table = spark.createDataFrame([(i, t, "en", 1.0, 5) for i, t in zip(ids, said)], "doc_id long, text string, lang string, score double, quality int")
    given = [(n, n % 2, 0) for n in range(120)] + [(5, 1, 0), (7, None, 0), (None, 1, 0)]
    labels = spark.createDataFrame(given, "doc_id long, quality int, toxic int")
    one = {t: quality.statistics(pa.array([t], pa.string()))[0] for t in said}
    learned = [
        (one[t], label) for i, t in zip(ids, said) for n, label, _ in given
        if n == i and label is not None and zlib.crc32(str(i).encode()) % 3 != 1
    ]
    wanted = dict(zip(said, plain_quadratic_scores(learned, [one[t] for t in said])))
    out = quality.score_quality(table, labels).collect()
    assert len(out) == len(said)
    by_id = dict(zip(ids, said))
    for row in out:
        assert abs(row.score - wanted[by_id[row.doc_id]]) < 1e-6
        assert row.predicted == (row.score >= 0.5)
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1)
    assert quality.score_quality(nothing, labels).count() == 0
    unlabelled = quality.score_quality(table, labels.where("false")).select("score").distinct().collect()
    assert [r.score for r in unlabelled] == [0.5]
