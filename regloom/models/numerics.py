"""NumPy mirrors of the model kernels, used *inside* Spark tasks
for the training sums: Gram matrices, memberships and gradients of one block of
rows at a time."""

from __future__ import annotations

import numpy as np

EPS = 1e-10


def fcm_memberships(X: np.ndarray, C: np.ndarray, m: float) -> np.ndarray:
    """(n, k) fuzzy-c-means memberships. Each row's sum of ``d_j^-e`` is formed
    once, so a membership costs the same however many clusters there are."""
    d = np.maximum(sq_dists(X, C).T, EPS * EPS)  # a cluster's values side by side
    near = d.min(axis=0) / d                      # scaled by the nearest, against overflow
    if m != 2.0:
        near **= 1.0 / (m - 1.0)
    raw = near / (near.sum(axis=0) + EPS * near)
    return (raw / (raw.sum(axis=0) + EPS)).T


def sq_dists(X: np.ndarray, C: np.ndarray) -> np.ndarray:
    """(n, k) squared Euclidean distances, a centre's side by side in memory."""
    out = np.zeros((len(C), len(X)))
    for x, c in zip(np.ascontiguousarray(X.T), C.T):
        diff = x - c[:, None]
        diff *= diff
        out += diff
    return out.T


def rbf_design(X: np.ndarray, centres: np.ndarray, sigmas: np.ndarray) -> np.ndarray:
    out = np.ones((len(centres) + 1, X.shape[0]))
    np.exp(sq_dists(X, centres).T / (-2.0 * sigmas[:, None] ** 2), out=out[:-1])
    return out.T


def anfis_mu(X: np.ndarray, mf_type: str, prm: dict) -> np.ndarray:
    """(n, d, m) clamped membership degrees."""
    c = np.asarray(prm["centers"])[None, :, :]
    x = X[:, :, None]
    diff = x - c
    if mf_type == "gaussian":
        mu = np.exp(-(diff ** 2) / (2 * np.asarray(prm["sigmas"])[None] ** 2 + EPS))
    elif mf_type == "bell":
        w = np.asarray(prm["widths"])[None]
        b = np.asarray(prm["slopes"])[None]
        mu = 1.0 / (1.0 + (diff / (w + EPS)) ** (2 * b) + EPS)
    else:
        lft = np.asarray(prm["lefts"])[None]
        rgt = np.asarray(prm["rights"])[None]
        mu = np.maximum(0, np.minimum((x - lft) / (c - lft + EPS), (rgt - x) / (rgt - c + EPS)))
    return np.clip(mu, 1e-10, 1.0)


def anfis_firing(mu: np.ndarray, rules: np.ndarray) -> np.ndarray:
    """(n, R) rule firing strengths: product of one degree per feature."""
    d = rules.shape[1]
    w = np.ones((mu.shape[0], rules.shape[0]))
    for j in range(d):
        w *= mu[:, j, rules[:, j]]
    return w


def augmented(X: np.ndarray) -> np.ndarray:
    return np.hstack([X, np.ones((X.shape[0], 1))])


def rule_design(weights_norm: np.ndarray, X: np.ndarray) -> np.ndarray:
    """(n, R*(d+1)) design ``w_norm_r * [x, 1]``, rule-major."""
    xa = augmented(X)
    return (weights_norm[:, :, None] * xa[:, None, :]).reshape(X.shape[0], -1)


def anfis_forward(X, mf_type, prm, rules):
    mu = anfis_mu(X, mf_type, prm)
    w = anfis_firing(mu, rules)
    wn = w / (w.sum(axis=1, keepdims=True) + EPS)
    return mu, w, wn


def anfis_design(X: np.ndarray, mf_type: str, prm: dict, rules: np.ndarray) -> np.ndarray:
    _, _, wn = anfis_forward(X, mf_type, prm, rules)
    return rule_design(wn, X)


# The rules are the whole grid (one membership of each feature), the first
# feature slowest. So the product of two rules' strengths is a product of one
# pair of memberships of each feature: m(m+1)/2 pairs a feature instead of m*m,
# and the Gram of the rule design has as many different entries as products of
# such pairs, times pairs of [x, 1]: 729 * 28 for the 448 columns of 64 rules.

def _grid(parts: list[np.ndarray], start: np.ndarray) -> np.ndarray:
    """(q, n) products of one row of each part, the first part slowest."""
    out = start
    for part in parts:
        out = (out[:, None, :] * part[None, :, :]).reshape(-1, part.shape[1])
    return out


def _pairs(k: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(k)


def _pair_at(k: int) -> np.ndarray:
    """(k, k) position of each unordered pair in :func:`_pairs`."""
    i, j = _pairs(k)
    out = np.zeros((k, k), dtype=np.int64)
    out[i, j] = out[j, i] = np.arange(len(i))
    return out


def _strengths(X, mf_type, prm) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Each feature's memberships (m, n), the rules' strengths (R, n) and their sum."""
    mu = [np.ascontiguousarray(one.T) for one in anfis_mu(X, mf_type, prm).transpose(1, 0, 2)]
    w = _grid(mu, np.ones((1, len(X))))
    return mu, w, w.sum(axis=0) + EPS


def anfis_predict(X: np.ndarray, mf_type: str, prm: dict, theta: np.ndarray) -> np.ndarray:
    """The rule design times ``theta``, without the design."""
    _, w, total = _strengths(X, mf_type, prm)
    return np.einsum("rn,rn->n", w, theta.reshape(len(w), -1) @ augmented(X).T) / total


def anfis_gram_size(d: int, m: int) -> int:
    return (m * (m + 1) // 2) ** d * ((d + 1) * (d + 2) // 2) + m ** d * (d + 1) + 2


def anfis_gram_sums(X, y, weights, mf_type: str, prm: dict) -> np.ndarray:
    """The different entries of the rule design's Gram, its products with the
    label, the label's square and the weights, added up over rows."""
    mu, w, total = _strengths(X, mf_type, prm)
    xa = augmented(X)
    i, j = _pairs(len(mu[0]))
    monomials = _grid([one[i] * one[j] for one in mu], (weights / total ** 2)[None, :])
    i, j = _pairs(xa.shape[1])
    wy = weights * y
    return np.concatenate([(monomials @ (xa[:, i] * xa[:, j])).ravel(), ((w / total) @ (xa * wy[:, None])).ravel(),
                           [wy @ y, weights.sum()]])


def anfis_gram(sums: np.ndarray, rules: np.ndarray, m: int) -> np.ndarray:
    """:func:`anfis_gram_sums` as all entries end to end: ``A'A``, ``A'y``, ``y'y``, n."""
    count, d = rules.shape
    p, own, inputs, at = count * (d + 1), _pair_at(m), _pair_at(d + 1), 0
    for j in range(d):
        at = at * (m * (m + 1) // 2) + own[rules[:, j][:, None], rules[:, j][None, :]]
    entries = sums[:-(p + 2)].reshape(-1, (d + 1) * (d + 2) // 2)
    return np.concatenate([entries[at[:, None, :, None], inputs[None, :, None, :]].ravel(), sums[-(p + 2):]])


def anfis_gradient_sums(X, y, prm, rules, theta, weights=1.0) -> np.ndarray:
    """Gaussian premise gradients summed over rows: array (2, d, m), one layer
    for the centres and one for the widths; the driver divides by the row count.

    With firing strengths ``w`` of sum ``S``, rule outputs ``f`` and prediction
    ``p``, rule r pulls with ``(p - y) (f_r - p) w_r (S - w_r) / S^2`` on the
    logarithm of each of its memberships. The rule x membership incidence
    matrix adds up the pulls of the rules that share a membership; a Gaussian's
    logarithm moves by ``(x - c) / s^2`` with its centre and ``(x - c)^2 / s^3``
    with its width."""
    mu, w, total = _strengths(X, "gaussian", prm)
    (n, d), m = X.shape, len(mu[0])
    outputs = theta.reshape(len(rules), d + 1) @ augmented(X).T
    p = np.einsum("rn,rn->n", w, outputs) / total
    outputs -= p
    outputs *= w
    outputs *= total - w
    outputs *= (p - np.asarray(y)) * weights / (total ** 2 + EPS)
    incidence = np.zeros((d * m, len(rules)))
    incidence[np.arange(d) * m + rules, np.arange(len(rules))[:, None]] = 1.0
    mu = np.stack(mu)
    on_log = (incidence @ outputs).reshape(d, m, n) * mu / (mu + EPS)
    width, gap = np.asarray(prm["sigmas"]), X.T[:, None, :] - np.asarray(prm["centers"])[:, :, None]
    return np.stack([np.einsum("jkn,jkn->jk", on_log, gap) / (width ** 2 + EPS),
                     np.einsum("jkn,jkn->jk", on_log, gap ** 2) / (width ** 3 + EPS)])


def fcm_activations(X, centres, sigmas, mf_type):
    d2 = sq_dists(X, centres)
    if mf_type == "bell":
        return 1.0 / (1.0 + (np.sqrt(d2) / (sigmas[None] + EPS)) ** 4 + EPS)
    return np.exp(-d2 / (2 * sigmas[None] ** 2 + EPS))


def fcm_design(X, centres, sigmas, mf_type):
    a = fcm_activations(X, centres, sigmas, mf_type)
    an = a / (a.sum(axis=1, keepdims=True) + EPS)
    return rule_design(an, X)


# ----- multilayer perceptron -------------------------------------------------

def act(z, kind):
    """The activation, in place."""
    if kind == "relu":
        return np.maximum(z, 0, out=z)
    if kind == "tanh":
        return np.tanh(z, out=z)
    if kind == "logistic":
        np.exp(np.negative(z, out=z), out=z)
        z += 1.0
        return np.divide(1.0, z, out=z)
    return z


def act_grad(a, kind):
    """Derivative expressed through the activation output ``a``."""
    if kind == "relu":
        return a > 0
    if kind == "tanh":
        return 1.0 - a ** 2
    if kind == "logistic":
        return a * (1.0 - a)
    return np.ones_like(a)


def unpack(theta: np.ndarray, sizes: list[int]):
    Ws, bs, o = [], [], 0
    for a, b in zip(sizes[:-1], sizes[1:]):
        Ws.append(theta[o:o + a * b].reshape(a, b))
        o += a * b
        bs.append(theta[o:o + b])
        o += b
    return Ws, bs


def mlp_forward(X, theta, sizes, kind):
    Ws, bs = unpack(theta, sizes)
    acts = [X]
    for i, (W, b) in enumerate(zip(Ws, bs)):
        z = acts[-1] @ W
        z += b
        acts.append(z if i == len(Ws) - 1 else act(z, kind))
    return acts


def mlp_loss_grad(X, y, theta, sizes, kind, weights=1.0):
    """Weighted sum over rows of 0.5*(pred - y)^2 and its gradient (no L2 term)."""
    Ws, _ = unpack(theta, sizes)
    acts = mlp_forward(X, theta, sizes, kind)
    delta = acts[-1][:, 0] - y
    loss = 0.5 * float((weights * delta) @ delta)
    grads_W, grads_b = [], []
    d = (weights * delta)[:, None]
    for i in range(len(Ws) - 1, -1, -1):
        grads_W.append(acts[i].T @ d)
        grads_b.append(d.sum(axis=0))
        if i > 0:
            d = d @ Ws[i].T
            d *= act_grad(acts[i], kind)
    grads_W.reverse()
    grads_b.reverse()
    g = np.concatenate([np.concatenate([gw.ravel(), gb]) for gw, gb in zip(grads_W, grads_b)])
    return loss, g


class MLPStep:
    """Mean loss and gradient of mini-batches, with the L2 term, at weights that
    are moved in place between calls; the gradient is overwritten by the next."""

    def __init__(self, sizes: list[int], kind: str, theta: np.ndarray, alpha: float):
        self.kind, self.alpha, self.theta = kind, alpha, theta
        self.grad = np.empty_like(theta)
        self.W, self.b = unpack(theta, sizes)
        self.gW, self.gb = unpack(self.grad, sizes)

    def gradient(self, X: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
        acts, last, n = [X], len(self.W) - 1, len(y)
        for i, (W, b) in enumerate(zip(self.W, self.b)):
            z = acts[-1] @ W
            z += b
            acts.append(z if i == last else act(z, self.kind))
        d = acts[-1]
        d -= y[:, None]
        loss = 0.5 * float(np.vdot(d, d)) / n
        d /= n
        for i in range(last, -1, -1):
            np.matmul(acts[i].T, d, out=self.gW[i])
            np.sum(d, axis=0, out=self.gb[i])
            if self.alpha:
                loss += 0.5 * self.alpha * float(np.vdot(self.W[i], self.W[i])) / n
                self.gW[i] += self.alpha / n * self.W[i]
            if i:
                d = d @ self.W[i].T
                d *= act_grad(acts[i], self.kind)
        return self.grad, loss
