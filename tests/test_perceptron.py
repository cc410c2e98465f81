"""The perceptron on blocks against Spark's own."""

import numpy as np

from lakekit.operators import cells as C, ml as M, perceptron as P
from tests.test_cells import rows, scores  # noqa: F401


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(1)
    sizes = [3, 5, 4, 2]
    w, x, y = rng.normal(size=3 * 5 + 5 + 5 * 4 + 4 + 4 * 2 + 2), rng.normal(size=(20, 3)), rng.integers(0, 2, 20)
    _, g = P.loss_and_gradient(w, sizes, x, y)
    for i in range(len(w)):
        d = np.zeros(len(w))
        d[i] = 1e-6
        assert abs((P.loss_and_gradient(w + d, sizes, x, y)[0] - P.loss_and_gradient(w - d, sizes, x, y)[0]) / 2e-6 - g[i]) < 1e-4


def test_minimum_of_a_valley():
    def valley(x):
        return 100 * (x[1] - x[0] ** 2) ** 2 + (1 - x[0]) ** 2, np.array([-400 * x[0] * (x[1] - x[0] ** 2) - 2 * (1 - x[0]), 200 * (x[1] - x[0] ** 2)])

    assert np.abs(P.minimise(valley, np.array([-1.2, 1.0]), 200, 1e-12) - 1).max() < 1e-4


def test_blocks_train_the_net_of_spark(rows):  # noqa: F811
    for iterations, far in ((1, 1e-3), (8, 0.01)):
        est = M.neural_net(rows.first().features.size, iterations=iterations)
        here, there = scores(C.Trainer(rows, least=1).fit(est), rows), scores(C.Trainer(rows).fit(est), rows)
        assert np.abs(here - there).mean() < far and (here != there).any()
