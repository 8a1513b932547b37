import numpy as np

from vialstream.llm import recurrent


def test_model_size():
    assert (recurrent.WORDS, recurrent.WORD_CLASSES, recurrent.RARE_CLASSES) == (4096, 64, 64)


def test_every_token_trains_and_padding_does_not():
    r = np.random.default_rng(1)
    counts = np.sort(r.integers(1, 500, 300))[::-1]
    lay = recurrent.Layout(counts, np.ones(recurrent.RARE_CLASSES))
    for n, streams in ((103, 4), (9, 4), (5, 4), (13, 5), (1000, 128)):
        ids = r.integers(0, 299, n)
        ids[-1] = 299  # a token that only the remainder holds
        begins = np.zeros(n, bool)
        begins[0] = True
        w = recurrent.start_weights(lay)
        before = w["x"].copy()
        t = recurrent.Trainer(w, lay, 0.1, streams=streams, window=3)
        seen = []
        t._apply, apply = (lambda key, grad, rows=slice(None): (seen.append(key), apply(key, grad, rows))), t._apply
        t.text(ids, begins)
        assert t.tokens == n and seen
        assert all((w["x"][k] == before[k]).all() for k in range(300) if k not in ids)
    # a padded window has the gradients of the same window without the padding
    x, b, live = r.integers(0, 300, (4, 2)), np.zeros((4, 2), bool), np.ones((4, 2), bool)
    live[2:, 1] = False
    got = []
    for fill in (0, 7):
        w = recurrent.start_weights(lay)
        x[2:, 1] = fill
        recurrent.Trainer(w, lay, 0.1).update(np.zeros((2, recurrent.HIDDEN), np.float32), x, b, live)
        got.append(w)
    assert all(np.allclose(got[0][k], got[1][k], atol=1e-6) for k in got[0])
