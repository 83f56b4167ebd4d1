import re

from tidings.llm.lines import boilerplate, drop_boilerplate
from tidings.llm.rules import host_verdicts, judge, text_figures


def test_boilerplate_of_a_host_goes(make_docs):
    rows = [(i, f"own {i}\n  home | about\n\nhome | about \nlast {i}", "a") for i in range(10)]
    rows += [(20 + i, "home | about\nfoot", "b" if i < 4 else None) for i in range(8)]
    docs = make_docs(rows)
    found = {(r["host"], r["pages"], r["host_pages"]) for r in boilerplate(docs, "source", 0.5, 4).collect()}
    assert found == {("a", 10, 10), ("b", 4, 4), ("", 4, 4)}
    for bound in (1000, 0):  # broadcast, and joined by host
        got = {r["doc_id"]: r for r in drop_boilerplate(docs, "source", 0.5, 4, bound).collect()}
        assert got[3]["text"] == "own 3\n\nlast 3" and (got[3]["n_lines"], got[3]["n_dropped"]) == (5, 2)
        assert got[20]["text"] == "" and got[20]["n_dropped"] == 2
        assert len(got) == 18
    assert drop_boilerplate(docs, "source", 0.5, 11).where("n_dropped > 0").count() == 0


def test_lines_of_odd_documents(odd_docs, no_docs):
    cleaned = drop_boilerplate(odd_docs, "source", 0.1, 2)
    assert set(cleaned.columns) == {*odd_docs.columns, "n_dropped"}
    rows = cleaned.collect()
    assert len(rows) == odd_docs.count()
    assert all(r["row"] == "clash" and r["host"] == "clash" for r in rows)
    assert {(r["text"], r["n_lines"]) for r in rows if r["doc_id"] == 0} == {(None, 0)}
    assert drop_boilerplate(no_docs).count() == 0


def _figures(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in (i, i + 1, i + 2)}
    lines = [line for line in text.split("\n") if re.search("[^\x20\x09-\x0d]", line)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(covered)
    )


def test_figures_against_brute_force(make_docs, odd_docs):
    texts = ["a b c a b c", "a a a a", "x y z # * $\nx y z\n x y z", "é|ö <b> q\n\n\nk\nk\nk", "p q r s p q", "a b a b a b a"]
    docs = make_docs([(i, t, "s") for i, t in enumerate(texts)])
    got = {r[0]: tuple(r)[1:] for r in text_figures(docs, "doc_id").collect()}
    assert got == {i: _figures(t) for i, t in enumerate(texts)}
    odd = odd_docs.where("length(text) < 10000 or text is null")
    wanted = sorted((repr((r["doc_id"], *_figures(r["text"]))) for r in odd.collect()))
    assert sorted(repr(tuple(r)) for r in text_figures(odd, "doc_id").collect()) == wanted


def test_small_hosts_are_drawn_to_the_mean(make_docs):
    good, bad = " ".join(f"w{i}" for i in range(60)), "too short"
    rows = [(i, bad if i % 10 == 0 else good, f"h{i % 12}") for i in range(600)]
    rows += [(1000, bad, "small"), *[(2000 + i, bad if i % 4 else good, "rotten") for i in range(200)]]
    rows += [(3000, good, "rotten")]
    judged = {r["doc_id"]: r for r in judge(make_docs(rows)).collect()}
    assert len(judged) == len(rows)
    assert not judged[2000]["kept"] and not judged[3000]["kept"] and not judged[3000]["base_failed"]
    assert judged[1]["kept"] and not judged[0]["kept"]
    verdicts = {r["host"]: r for r in host_verdicts(text_figures(make_docs(rows).drop("host").withColumnRenamed("source", "host"), "doc_id", "host")).collect()}
    assert verdicts["small"]["rate_short"] < 1 and not verdicts["rotten"]["host_kept"]


def test_rules_of_odd_documents(odd_docs, no_docs):
    rows = judge(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(r["kept"] is not None for r in rows)
    assert judge(no_docs).count() == 0


def test_a_line_on_a_twentieth_of_a_host_goes_and_chance_stays(make_docs):
    rows = [(i, f"own {i}\n{'Subscribe now' if i % 20 == 0 else 'text'} \nlast {i}\n" + ("met by chance" if i in (3, 5) else f"x{i}"), "a") for i in range(400)]
    rows += [(1000 + i, "Subscribe now" if i == 0 else f"w{i}", "b") for i in range(100)]
    got = {r["doc_id"]: r["text"] for r in drop_boilerplate(make_docs(rows)).collect()}
    assert got[40] == "own 40\nlast 40\nx40" and got[3] == "own 3\nlast 3\nmet by chance" and got[1000] == "Subscribe now"
