import itertools

import pytest
from llm_cases import frame, rows
from pyspark.sql import functions as F

from flightlake.llm import pii as P

S = P.Surrogates(b"test key")


@pytest.mark.parametrize("sizes", [[10, 10], [5, 21, 5], [7], [2, 1], [3, 4, 5, 6], [1, 1, 2]])
def test_permutations_are_one_to_one_without_fixed_points(sizes):
    p = P.Permutation(b"k")
    every = list(itertools.product(*map(range, sizes)))
    moved = [tuple(p.move(list(x), sizes, "t")) for x in every]
    assert sorted(moved) == every and all(a != b for a, b in zip(every, moved, strict=True))


def spans(text):
    return [(k, text[a:b]) for a, b, k in P.find(text)]


def test_findings():
    assert spans("mail Bob.Smith@mail7.example.com, now") == [("email", "Bob.Smith@mail7.example.com")]
    assert spans("call +1 (569) 555-7279 or 569-555-7279!") == [("phone", "+1 (569) 555-7279"), ("phone", "569-555-7279")]
    assert spans("ip 128.212.154.77, 999.1.1.1 v1.2.3.4 1.2.3.4.5") == [("ip", "128.212.154.77")]
    assert spans("4111 1111 1111 1111 and 4111 1111 1111 1112") == [("card", "4111 1111 1111 1111")]
    assert spans("123-45-6789 DE89 3704 0044 0532 0130 00") == [("ssn", "123-45-6789"), ("iban", "DE89 3704 0044 0532 0130 00")]
    assert spans("Mr. James Carter met Dr. Müller and Анна Иванова") == [("name", "James Carter"), ("name", "Müller"), ("name", "Анна Иванова")]
    assert spans("The An. This Is v2.0.1 on 2020-01-02 at 10:20, 3,000 of 1.5") == []


def test_surrogates_keep_kind_format_and_coreference():
    for kind, value in [("email", "Bob.Smith-1@mail7.example.com"), ("email", "jo@shop.org"), ("phone", "+1 (569) 555-7279"), ("ip", "8.8.8.8"),
                        ("card", "4111 1111 1111 1111"), ("ssn", "123-45-6789"), ("iban", "DE89 3704 0044 0532 0130 00"), ("name", "Анна Иванова"),
                        ("name", "James Carter")]:
        new = S.of(kind, value)[0]
        assert new != value and spans(new) == [(kind, new)] and new == P.Surrogates(b"test key").of(kind, value)[0]
        assert new != P.Surrogates(b"another").of(kind, value)[0]
    tail = lambda v: "".join(c for c in S.of("phone", v)[0] if c.isdigit())[-10:]
    assert tail("+1 (569) 555-7279") == tail("569-555-7279") == tail("569 555 7279")
    assert S.of("email", "BOB@mail1.example.com")[0].lower() == S.of("email", "bob@mail1.example.com")[0]
    assert P._GIVEN[S.of("name", "Анна Иванова")[0].split()[0]] == ("cyrillic", "female")
    assert P._GIVEN[S.of("name", "James Carter")[0].split()[0]] == ("latin", "male")


def test_distinct_entities_stay_distinct():
    values = {"ip": [f"10.0.{a}.{b}" for a in range(30) for b in range(30)], "phone": [f"555-01{n // 100}-{n:04d}" for n in range(900)],
              "email": [f"a{n}@m{n % 7}.example.com" for n in range(900)], "name": [f"{g} Ba{c}en" for g in P._GIVEN for c in "bcdfgh"]}
    for kind, known in values.items():
        known = [v for v in known if (kind, v) in spans(v)]
        new = {S.of(kind, v)[0] for v in known}
        assert len(known) > 100 and len(new) == len(set(known)) and all(S.of(kind, v)[0] != v for v in known)


PERSONAL = [(700, "é 🙂 write jo.98@mail5.example.com or JO.98@mail5.example.com from 249.53.94.59 now", "en", "s", 0),
            (701, "jo.98@mail5.example.com", "en", "s", 0), (701, "jo.98@mail5.example.com", "en", "s", 0)]


def test_rows(spark):
    data = rows() + PERSONAL
    df = frame(spark, data, extra=True)
    out = P.pseudonymise(df, b"key", {"doc_id": F.col("doc_id"), "before": F.col("text")}).collect()
    assert len(out) == len(data)
    for r in out:
        if r.before is None:
            assert r.text is None and r.n_entities == 0
        elif not P.find(r.before):
            assert r.text == r.before and r.n_entities == 0 and r.entities == ""
        else:
            listed = [s.split(":") for s in r.entities.split(",")]
            assert [k for k, *_ in listed] == [k for _, _, k in P.find(r.before)] and r.n_entities == len(listed)
            assert all(P.find(r.text[int(a) : int(b)]) for _, a, b in listed)
    texts = {r.doc_id: r.text for r in out if r.doc_id in (700, 701)}
    assert "jo.98" not in texts[700].lower() and "249.53" not in texts[700] and texts[701] in texts[700]
    assert P.collisions(df, b"key").count() == 0
    assert P.pseudonymise(frame(spark, [])).count() == 0


def test_shared_surrogates_are_drawn_again(spark, monkeypatch):
    df = frame(spark, [(1, "a1@m.example.com and b2@m.example.com", None, None, 0)])
    assert P.resolved(df) == {} and P.pseudonymise(df).count() == 1
    one = P.Surrogates(P.DEMO_KEY)
    greater = max(map(one.digest, ("a1@m.example.com", "b2@m.example.com")))
    calls = []

    def found(df_, key, text_col, again):
        calls.append(dict(again))
        rows = [("email", "x", 2, "0", greater)] if not again else []
        return spark.createDataFrame(rows, "kind string, surrogate string, entities bigint, first string, last string")
    monkeypatch.setattr(P, "collisions", found)
    assert P.resolved(df) == {greater: 1} and calls == [{}, {greater: 1}]
    # The one drawn again takes the next surrogate of its form, the other keeps its own.
    twice = P.Surrogates(P.DEMO_KEY, {greater: 1})
    for value in ("a1@m.example.com", "b2@m.example.com"):
        first = one.of("email", value)[0]
        want = one.of("email", first)[0] if one.digest(value) == greater else first
        assert twice.of("email", value)[0] == want and want in P.pseudonymise(df).first().text


def test_no_part_of_a_name_stays():
    for value in ["Иван Ян", "James Øø", "Íé", "Анна Эюя", "Павел Щю", "Иван Ли", "Мария Ан", "Ирина Во", "Çã", "Íñigo", "Ольга Йо"]:
        new = S.of("name", value)[0]
        assert not set(new.split()) & set(value.split()) and [len(p) for p in new.split()][-1] == len(value.split()[-1]), (value, new)
    families = [a + b + c for a in "БВГ" for b in "аеи" for c in ("", "н", "й", "нов", "на", "ко", "ль", "щий", "эв", "ова", "ь")]
    made = [S.of("name", f)[0] for f in families]
    assert len(set(made)) == len(families) and not [f for f, m in zip(families, made, strict=True) if f == m]


def test_many_findings_in_one_text():
    import time
    text = " ".join(f"u{i}@m{i % 50}.example.com" for i in range(100_000))
    start = time.time()
    found = P.find(text)
    assert len(found) == 100_000 and found == sorted(found) and time.time() - start < 60
    people = " ".join(f"Mr James Ba{'bcdfg'[i % 5]}{'aeiou'[i // 5 % 5]}{'klmn'[i // 25 % 4]}on met {i}." for i in range(20_000))
    assert sum(k == "name" for _, _, k in P.find(people)) == 20_000


def test_later_mentions_by_one_name():
    text = "Carter left. James Carter met Dr. Müller; Carter's plan pleased James, not Müller (Carters, MyJames, Jameson). Mary Young's dog; Young."
    assert spans(text) == [("name", "Carter"), ("name", "James Carter"), ("name", "Müller"), ("name", "Carter"), ("given", "James"),
                           ("name", "Müller"), ("name", "Mary Young"), ("name", "Young")]
    new, listed = P.replace(text, S)
    parts = S.of("name", "James Carter")[0].split()
    assert [new[a:b] for a, b, _ in listed][:5] == [parts[1], " ".join(parts), S.of("name", "Müller")[0], parts[1], parts[0]]
    assert spans("Carter and James met nobody") == []


def test_later_mentions_in_rows(spark):
    df = frame(spark, [(1, "Anna rang. Mrs Anna Bauer and Bauer spoke to James Thomas; Thomas left, Thomas Bauer stayed.", None, None, 0)])
    text = P.pseudonymise(df).first().text
    assert not {"Anna", "Bauer", "James", "Thomas"} & set(text.replace(".", " ").replace(",", " ").replace(";", " ").split())


def test_national_phones():
    for v in ["06 12 34 56 78", "06.12.34.56.78", "0612345678", "030 1234567", "(030) 1234567", "0171/2345678", "020 7946 0958", "07700 900123",
              "612 345 678", "612 34 56 78", "91 234 56 78"]:
        new = S.of("phone", v)[0]
        assert spans(f"tel {v}, now") == [("phone", v)] and new != v and spans(new) == [("phone", new)], (v, new)
    assert spans("01.02.2024 10:20, 01/02/2024 12 34, 2020-01-02, 0.12 345 678, 1 234 567, 05 06") == []
    known = [f"06 {n:02d} 34 56 78" for n in range(100)] + [f"612 345 {n:03d}" for n in range(300)] + [f"555-010-{n:04d}" for n in range(300)]
    assert len({"".join(S.of("phone", v)[0].split()) for v in known}) == len(known)
