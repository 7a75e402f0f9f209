"""Personal data in lists: neighbouring items of one kind are found one by one."""

from tradewind.llm import personal_data


def spans_of(text, label, base=()):
    runs = personal_data.candidate_runs(text)
    return [text[a:b] for a, _, b in personal_data.added_spans(text, runs, [[label] * len(r.spans) for r in runs], list(base))]


def test_lists_of_one_kind_are_split():
    phones = [f"212-555-01{k}" for k in range(10, 40)]
    for blank in ("\n", " ", "\n\n"):
        assert spans_of(blank.join(phones), 4) == phones
    assert spans_of("(212) 555-0142\n(212) 555-0143\n(212) 555-0144", 4) == ["(212) 555-0142", "(212) 555-0143", "(212) 555-0144"]
    cards = ["4111 1111 1111 1111", "5500 0000 0000 0004"]
    assert spans_of(" ".join(cards), 3) == cards
    assert spans_of("10.1.2.3:80 10.1.2.4:8080", 2) == ["10.1.2.3:80", "10.1.2.4:8080"]


def test_base_spans_are_taken_out_and_the_rest_stays():
    text = "212-555-0187 +1 212 555 0199 212-555-0188 7"
    assert spans_of(text, 4, [(13, 3, 28)]) == ["212-555-0187", "212-555-0188 7"]
    assert spans_of("ab212-555-0187", 4, [(0, 0, 2)]) == ["212-555-0187"]
    assert spans_of("212-555-0187 5", 4, [(0, 3, 14)]) == []


def test_lists_are_masked_as_a_whole():
    model = personal_data.train()
    for text in ("call 212-555-0187\n212-555-0188\n212-555-0189", "call 212-555-0187 212-555-0188"):
        [(_, spans)] = personal_data.find_spans([text], model)
        assert "555" not in personal_data.masked(text, spans)


def test_features_come_from_the_whole_word():
    [run] = personal_data.candidate_runs("x" * 300 + "@example 1")
    assert "has=@" in run.features[0]
