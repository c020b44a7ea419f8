"""What chunks of the Markov model take in an exchange."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from ledgerlens.llm import markov_model


def test_codes_are_packed_without_loss():
    rng = np.random.default_rng(4)
    for codes in (np.array([0]), np.array([70_000, 1, 2 ** 32 - 1]), rng.integers(0, 900, 50_000)):
        stored = markov_model.packed(codes).tobytes()
        assert markov_model.unpacked(stored, len(codes)).tolist() == codes.tolist()
    assert len(stored) < 0.8 * pa.compress(codes.astype("<u4").tobytes(), codec="lz4").size


def test_recursions_hold_a_row_a_state():
    rng = np.random.default_rng(5)
    share = lambda x: x / x.sum(axis=-1, keepdims=True)
    model = markov_model.Model(share(rng.random(3)), share(rng.random((3, 3))), share(rng.random((3, 5))), {})
    _, steps, states, _, scales = markov_model.forward(model, np.array([0, 4]), np.array([4, 2]), np.arange(6) % 5)
    assert states.shape == (3, 6) and scales.shape == (6,)
    assert (steps.live, steps.at, steps.classes.tolist()) == ([2, 2, 1, 1], [0, 2, 4, 5], [0, 4, 1, 0, 2, 3])


def test_documents_of_neighbouring_chunks_are_taken_together():
    """A long document of each chunk shares the steps of the recursion; counts are those of the chunks one by one."""
    rng = np.random.default_rng(6)
    share = lambda x: x / x.sum(axis=-1, keepdims=True)
    model = markov_model.Model(share(rng.random(3)), share(rng.random((3, 3))), share(rng.random((3, 7))), {})
    rows = []
    for lengths in ([3, 40], [41, 1, 2], [5]):
        codes = rng.integers(0, 4, sum(lengths))
        rows.append({"doc_ids": np.arange(len(lengths), dtype="<i8").tobytes(), "null_ids": bytes(len(lengths)),
                     "held_out": bytes([0] * (len(lengths) - 1) + [1]), "lengths": np.array(lengths, "<u4").tobytes(),
                     "codes": markov_model.packed(codes).tobytes(), "class_of": rng.integers(0, 7, 4).astype("<u4").tobytes()})
    batches = pa.Table.from_pylist(rows).to_batches()

    def counted(together):
        counts, groups = (np.zeros(3), np.zeros((3, 3)), np.zeros((3, 7))), []
        for chunks, folds, starts, lengths, classes in markov_model._together(batches, markov_model.Settings(together=together)):
            groups.append(len(chunks))
            markov_model.expect(model, starts[np.argsort(-lengths)], -np.sort(-lengths), classes, counts)
            assert folds.tolist() == [x for _, c in chunks for x in c.held_out.tolist()]
        return groups, np.concatenate([c.reshape(-1) for c in counts])

    (apart, one_by_one), (joined, at_once) = counted(1), counted(80)
    assert (apart, joined) == ([1, 1, 1], [2, 1])
    assert np.allclose(one_by_one, at_once, rtol=1e-12) and np.isclose(at_once[:3].sum(), 6)
