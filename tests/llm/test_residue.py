import random

from inkwell.llm import residue as R

NAMES = ["title", "author", "lead"]


def corpus(n=1200, seed=3):
    """(id, text, title, source, is_case) with all kinds of cases and of look-alikes."""
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("mor", "tal", "ven", "sil", "ka", "lu", "pe") for b in ("ina", "ost", "erel", "and", "ik", "oum", "ade")]
    say = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(5, 12))).capitalize() + "."
    rows = []
    for i in range(n):
        body, case, kind = [say() for _ in range(rng.randint(2, 6))], False, rng.random()
        if kind < 0.08:
            body.insert(rng.randint(0, 2), rng.choice(["{{ article.%s }}", "[[%s]]", "$%s$", "{%s}"]) % rng.choice(NAMES))
            case = True
        elif kind < 0.14:
            body, case = [rng.choice(["404 Page not found", "HTTP 503: Bad gateway", "Access denied (403)", "Please enable JavaScript to read this article."])], True
        elif kind < 0.18:
            body[1] = "Lorem ipsum dolor amet elit. Elit dolor sit amet tempora."
            case = True
        elif kind < 0.24:
            body[0] = 'The message "404 Page not found" is older than most readers think.'
        elif kind < 0.30:
            body[0] = rng.choice(["In the template you write `{{author}}` for it.", "The set {0} has one member.", "Listing 3 shows it:\n<p>{{ title.name }}</p>\nGET /v3/title -> 404"])
        rows.append((i, rng.choice([" ", "\n"]).join(body), "A title", f"host{i % 11}", case))
    return rows


def test_cases_and_look_alikes(spark):
    rows = corpus()
    extra = [(90001, None, None, None, False), (90002, "", None, "host1", False), (90003, " \n\t", "t", "host1", False), (90004, "<|endoftext|> &nbsp; <br/>", None, "host2", False)]
    df = spark.createDataFrame([r[:4] + (0,) for r in rows + extra], "doc_id long, text string, title string, source string, label int")
    got = {r.doc_id for r in R.classify(df, True).collect()}
    want = {r[0] for r in rows if r[4]}
    assert len(got & want) >= 0.97 * len(want), sorted(want - got)[:5]
    assert len(got - want) <= 0.03 * len(want), sorted(got - want)[:5]
    assert not got & {r[0] for r in extra}
    clean = R.classify(df, False, keep=("text",))
    assert clean.count() == len(rows) + len(extra) - len(got)
    figures = {r.metric: r.value for r in R.validation(df).collect()}
    assert figures["precision"] > 0.9 and figures["recall"] > 0.8


def test_masks():
    assert R.tokens("say „{{x}}“ now") == ["say", "⟨q⟩", "now"]
    assert R.tokens("say {{ x.y | upper }} now") == ["say", "⟨slot⟩", "now"]
    assert R.tokens("<p>{{ a.name }}</p>") == ["⟨code⟩"]
    assert R.tokens("the [sic] and $5 and 50% and #tag") == ["the", "[sic]", "and", "$5", "and", "50%", "and", "#tag"]


def test_slot_names_of_other_letters_and_lengths():
    for slot in ("[[úvod]]", "<<článek>>", "{úvod}", "${úvod}", "#ÚVOD#", "__ÚVOD__", "$čas$", "[NÁZEV]", "[ÜBERSCHRIFT]", "{{ " + "a" * 90 + " }}", "[[" + "long name " * 9 + "]]"):
        assert R.tokens(f"text {slot} text") == ["text", "⟨slot⟩", "text"], slot
    assert R.tokens("the [Název] and [čtvrtek] and {{ open") == ["the", "[Název]", "and", "[čtvrtek]", "and", "{{", "open"]


def test_copies_and_no_labels(spark):
    df = spark.createDataFrame([(1, "plain words only", "t", "s"), (2, "plain words only", "t", "s")], "doc_id long, text string, title string, source string")
    assert R.classify(df, True).count() == 0 and R.classify(df, False).count() == 2
    assert R.classify(df.limit(0), True).count() == 0
    assert R.validation(df.limit(0)).count() == 0


def test_every_phrase_is_found_by_strings_it_needs():
    import re

    phrases = [x for p in (*R.PHRASES.values(), R.SHORT_PHRASES) for x in R.alternatives(p.replace(r"\1", R._AGAIN))]
    assert len(phrases) > 200 and all(R.needed(re._parser.parse(x)) for x in phrases)
    assert R.alternatives(r"a(?:b|c)|[|)]d|e\|f") == ["a(?:b|c)", "[|)]d", r"e\|f"]
    for words, want in (
        ("the page was not found", True), ("error 404", True), ("fatal error call to a member function x", True), ("bla bla", True), ("insert the name of the town here", True), ("platzhalter", True),
        ("he spoke of a placeholder that nobody had ever seen in the town", False), ("404 cm from the marker", True), ("a lamp on the shelf", False), ("", False)):
        assert R.weak_label(words) is want, words
