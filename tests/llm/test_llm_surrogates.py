import collections
import re

from wordloom.llm import surrogates as S

TEXT = ("Mail und.34@mail7.example.com or Und.34@Mail7.example.com, call +1 (017) 555-7713 or +10175557713; IP 97.51.17.173. "
        "Card 4845168114407329 and 4845 1681 1440 7329. Mr. John Smith met Mrs Anna Maria Lopez-García and Dr Smith, "
        "госпожа Анна Иванова. SSN 123-45-6789 v4.0. +1 (826) 555-4081 190.137.223.204")


def luhn_ok(digits):
    return S._luhn(digits[:-1]) == int(digits[-1])


def test_permutations_are_bijections():
    for size in (1, 2, 7, 100, 1000):
        assert sorted(S.permuted(b"k", "t", i, size) for i in range(size)) == list(range(size))
    pairs = {S.shaped(b"k", "t", f"{a}{n}") for a in "abcxyz" for n in range(10)}
    assert len(pairs) == 60 and all(re.fullmatch("[a-z][0-9]", p) for p in pairs)
    assert S.shaped(b"k", "t", "é-я9") != S.shaped(b"j", "t", "é-я9")


def test_kinds_formats_and_coreference():
    new, spans = S.replaced(b"k", TEXT, {})
    kinds = collections.Counter(k for k, *_ in spans)
    assert kinds == {"email": 2, "phone": 3, "ip": 2, "card": 2, "ssn": 1, "given": 4, "surname": 4}
    found = collections.defaultdict(list)
    for k, a, b in spans:
        found[k].append(new[a:b])
    assert found["email"][0].lower() == found["email"][1].lower() and found["email"][1][0].isupper()
    assert re.fullmatch(r"[a-z]{3}\.\d\d@[a-z]{4}\d\.example\.com", found["email"][0])
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", found["phone"][0])
    assert re.sub(r"\D", "", found["phone"][0]) == re.sub(r"\D", "", found["phone"][1])
    assert found["card"][0] == found["card"][1].replace(" ", "")
    assert luhn_ok(found["card"][0]) == luhn_ok("4845168114407329")
    assert found["surname"][0] == found["surname"][2] and "Smith" not in new
    assert found["given"][0] in S.GIVEN[("latin", "m")] and found["given"][1] in S.GIVEN[("latin", "f")]
    assert found["given"][3] in S.GIVEN[("cyrillic", "f")] and S.script(found["surname"][3]) == "cyrillic"
    outside = [x for x in re.split("|".join(map(re.escape, sorted((x for v in found.values() for x in v), key=len, reverse=True))), new)]
    assert all(x in TEXT for x in outside) and "v4.0" in new


def test_names_stay_distinct_over_the_corpus(spark):
    names = [f"Mr {a}{b} {c}son" for a in "ABCDEFGH" for b in ("lan", "ob", "eter", "arl", "red") for c in ("Ander", "Peter")]
    rows = [(i, f"{n} was here.") for i, n in enumerate(names)] + [(100, names[3]), (None, None), (7, ""), (8, "no data")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, again string, k1 int").repartition(3)
    got = S.pseudonymize(df, b"k").collect()
    assert len(got) == len(rows)
    new = {r.id: r.text for r in got if r.id is not None and 8 < r.id < 100}
    assert len(set(new.values())) == len(new)
    assert next(r.text for r in got if r.id == 100) + " was here." == next(
        r.text for r in got if r.id == 3 and r.text)
    assert [r.text for r in got if r.id is None] == [None] and "no data" in {r.text for r in got if r.id == 8}
    for r in got:
        assert r.n_entities == len(r.entities) == len(S.find(r.text)) if r.text else r.n_entities == 0


def test_surrogates_of_a_corpus_are_distinct(spark, odd_docs, odd_rows):
    ents = [("email", "", f"{a}{b}@mail{n}.example.com") for a in "abcdefgh" for b in "xyz" for n in range(10)]
    ents += [("ip", "", f"10.0.{i}.{j}") for i in range(20) for j in range(20)]
    ents += [("given", "latin/m", f"name{i}") for i in range(200)]
    out = S.assigned(spark.createDataFrame(ents, "kind string, grp string, canon string"), b"k").collect()
    assert len(out) == len(ents) == len({(r.kind, r.surrogate) for r in out})
    assert S.pseudonymize(odd_docs, b"k").count() == len(odd_rows)


def test_empty_table(no_docs):
    assert S.pseudonymize(no_docs, b"k").count() == 0


def test_names_without_a_title():
    """Later mentions of a titled name, listed given names before a surname, and what follows from these."""
    text = ("Mr John Smith came. Smith said that JOHN and John Smith's friend Mary Q. Jones met Dr Kim Brown. Jones left; Mary "
            "and Brown stayed, the smith and a brown dog too. Сергей Иванов и Иванов.")
    new, spans = S.replaced(b"k", text, {})
    found = [(k, new[a:b]) for k, a, b in spans]
    for name in ("Smith", "John", "JOHN", "Mary", "Jones", "Brown", "Kim", "Сергей", "Иванов"):
        assert not re.search(rf"(?<!\w){name}(?!\w)", new), name
    kinds = [k for k, _ in found]
    assert kinds == ["given", "surname", "surname", "given", "given", "surname", "given", "surname", "given", "surname",
                     "surname", "given", "surname", "given", "surname", "surname"]
    smith, john, mary, jones = found[1][1], found[0][1], found[6][1], found[7][1]
    assert found[2][1] == found[5][1] == smith and found[3][1] == john.upper() and found[4][1] == john
    assert found[10][1] == jones and found[11][1] == mary and found[12][1] == found[9][1] and found[15][1] == found[14][1]
    assert "the smith and a brown dog" in new and f"{smith}'s friend" in new and " Q. " in new
    assert S.find("The House of Commons met. Smith came.") == []
