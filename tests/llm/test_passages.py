"""Repeated passages of 51 to 80 words at any place, with the default sizes."""

import random

from scorekeep.llm import substring_dedup as sd


def _own(r, n):
    return [f"v{r.getrandbits(60):x}" for _ in range(n)]


def test_every_passage_of_over_50_words_goes(docs_of):
    r, rows, planted = random.Random(3), [], {}
    for k in range(240):
        n = 51 if k < 120 else r.randrange(51, 81)
        passage = _own(r, n)
        if k % 4 == 1:  # sentences of 17 words, the first after text without a stop
            passage = [w + "." if i % 17 == 16 else w for i, w in enumerate(passage)]
        elif k % 4 == 2:
            passage = [w + "." if r.random() < 0.08 else w for w in passage]
        for copy in range(2):
            before, after = _own(r, r.randrange(40)), _own(r, r.randrange(40))
            mark = "\n\n" if k % 4 == 3 else " "  # as one sentence in a paragraph of its own
            rows.append((2 * k + copy, mark.join(" ".join(x) for x in (before, passage, after))))
        planted[2 * k + 1] = passage, len(before), len(after)
    got = {x.doc_id: x for x in sd.substring_dedup(docs_of(rows)).collect()}
    for i, text in rows:
        if i % 2 == 0:
            assert got[i].text == text and got[i].n_removed == 0
        else:
            passage, before, after = planted[i]
            left, all_words = got[i].text.split(), text.split()
            a = next(j for j, w in enumerate([*left, None]) if w != all_words[j])
            b = a + len(all_words) - len(left)  # the words removed are one run, inside the passage
            assert left == all_words[:a] + all_words[b:] and b - a >= sd.PIECE_WORDS, i
            assert before <= a and b <= len(all_words) - after, i
