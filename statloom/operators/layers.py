"""Forward and backward pass of a layered network on one mini-batch, in numpy.

A network is a tuple of layers: ("dense", inputs, outputs), ("dense_one_bias", inputs, outputs),
("conv", channels_in, channels_out, size), ("image", channels, height, width), ("flatten",),
("relu",), ("pool",), ("dropout", rate). Parameters are one flat list of arrays.
"""

from __future__ import annotations

import numpy as np

Layers = tuple[tuple, ...]


def shapes(layers: Layers) -> list[tuple[int, ...]]:
    result = []
    for kind, *size in layers:
        if kind == "dense":
            result += [(size[0], size[1]), (size[1],)]
        elif kind == "dense_one_bias":
            result += [(size[0], size[1]), (1,)]
        elif kind == "conv":
            result += [(size[0] * size[2] ** 2, size[1]), (size[1],)]
    return result


def count_parameters(layers: Layers) -> int:
    return sum(int(np.prod(s)) for s in shapes(layers))


def initial(layers: Layers, seed: int, how: str = "fan_in") -> list[np.ndarray]:
    """Uniform within 1/sqrt(fan in), or standard normal weights with zero biases."""
    rng = np.random.default_rng(seed)
    params = []
    for s in shapes(layers):
        if how == "normal":
            params.append(rng.standard_normal(s) if len(s) == 2 else np.zeros(s))
        else:
            fan = s[0] if len(s) == 2 else params[-1].shape[0]
            params.append(rng.uniform(-1.0, 1.0, s) / np.sqrt(fan))
    return params


def flat(params: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([p.reshape(-1) for p in params])


def unflat(values: np.ndarray, layers: Layers) -> list[np.ndarray]:
    params, at = [], 0
    for s in shapes(layers):
        n = int(np.prod(s))
        params.append(values[at : at + n].reshape(s))
        at += n
    return params


def _patches(x: np.ndarray, size: int) -> np.ndarray:
    """Zero-padded neighbourhoods of every pixel, one row each."""
    pad = size // 2
    padded = np.pad(x, ((0, 0), (0, 0), (pad, pad), (pad, pad)))
    windows = np.lib.stride_tricks.sliding_window_view(padded, (size, size), axis=(2, 3))
    return windows.transpose(0, 2, 3, 1, 4, 5).reshape(x.shape[0] * x.shape[2] * x.shape[3], -1)


def _unpatch(grad: np.ndarray, shape: tuple[int, ...], size: int) -> np.ndarray:
    n, c, h, w = shape
    pad = size // 2
    cells = grad.reshape(n, h, w, c, size, size)
    padded = np.zeros((n, c, h + 2 * pad, w + 2 * pad))
    for i in range(size):
        for j in range(size):
            padded[:, :, i : i + h, j : j + w] += cells[:, :, :, :, i, j].transpose(0, 3, 1, 2)
    return padded[:, :, pad : pad + h, pad : pad + w]


def forward(layers: Layers, params: list[np.ndarray], x: np.ndarray, rng=None) -> tuple[np.ndarray, list]:
    """Output and what the backward pass needs. Dropout acts only when `rng` is given."""
    saved, p = [], 0
    for kind, *size in layers:
        if kind in ("dense", "dense_one_bias"):
            saved.append(x)
            x = x @ params[p] + params[p + 1]
            p += 2
        elif kind == "conv":
            cells = _patches(x, size[2])
            saved.append((cells, x.shape))
            n, _, h, w = x.shape
            x = (cells @ params[p] + params[p + 1]).reshape(n, h, w, size[1]).transpose(0, 3, 1, 2)
            p += 2
        elif kind == "relu":
            saved.append(x > 0)
            x = np.maximum(0.0, x)
        elif kind == "pool":
            n, c, h, w = x.shape
            quads = x[:, :, : h // 2 * 2, : w // 2 * 2].reshape(n, c, h // 2, 2, w // 2, 2)
            quads = quads.transpose(0, 1, 2, 4, 3, 5).reshape(n, c, h // 2, w // 2, 4)
            best = quads.argmax(axis=4)
            saved.append((best, x.shape))
            x = np.take_along_axis(quads, best[..., None], axis=4)[..., 0]
        elif kind == "dropout":
            keep = None if rng is None else (rng.random(x.shape) >= size[0]) / (1.0 - size[0])
            saved.append(keep)
            x = x if keep is None else x * keep
        elif kind == "image":
            saved.append(x.shape)
            x = x.reshape(len(x), *size)
        elif kind == "flatten":
            saved.append(x.shape)
            x = x.reshape(len(x), -1)
        else:
            raise ValueError(f"unknown layer {kind!r}")
    return x, saved


def backward(layers: Layers, params: list[np.ndarray], saved: list, grad: np.ndarray) -> list[np.ndarray]:
    """Gradient of every parameter by the chain rule, from the gradient of the output."""
    grads: list[np.ndarray] = []
    p = len(params)
    for (kind, *size), kept in zip(reversed(layers), reversed(saved)):
        if kind in ("dense", "dense_one_bias"):
            p -= 2
            bias = grad.sum(axis=0) if kind == "dense" else np.array([grad.sum()])
            grads = [kept.T @ grad, bias, *grads]
            if p == 0:
                break  # nothing trainable lies before the first layer
            grad = grad @ params[p].T
        elif kind == "conv":
            p -= 2
            cells, shape = kept
            rows = grad.transpose(0, 2, 3, 1).reshape(-1, size[1])
            grads = [cells.T @ rows, rows.sum(axis=0), *grads]
            if p == 0:
                break  # nothing trainable lies before the first convolution
            grad = _unpatch(rows @ params[p].T, shape, size[2])
        elif kind == "relu":
            grad = grad * kept
        elif kind == "pool":
            best, (n, c, h, w) = kept
            quads = np.zeros((*best.shape, 4))
            np.put_along_axis(quads, best[..., None], grad[..., None], axis=4)
            full = quads.reshape(n, c, h // 2, w // 2, 2, 2).transpose(0, 1, 2, 4, 3, 5)
            grad = np.zeros((n, c, h, w))
            grad[:, :, : h // 2 * 2, : w // 2 * 2] = full.reshape(n, c, h // 2 * 2, w // 2 * 2)
        elif kind == "dropout":
            grad = grad if kept is None else grad * kept
        else:
            grad = grad.reshape(kept)
    return grads


def loss_and_gradient(output: np.ndarray, y: np.ndarray, loss: str) -> tuple[float, np.ndarray]:
    """Mean loss of a batch and its gradient with respect to the output."""
    n = len(y)
    if loss == "squared":
        gap = output - y.reshape(output.shape)
        return float((gap**2).mean()), 2.0 * gap / gap.size
    top = output.max(axis=1, keepdims=True)
    e = np.exp(output - top)
    share = e / e.sum(axis=1, keepdims=True)
    label = y.astype(int)
    log_share = output[np.arange(n), label] - top[:, 0] - np.log(e.sum(axis=1))
    share[np.arange(n), label] -= 1.0
    return float(-log_share.mean()), share / n


# Layer sizes, dropout rates and kernel sizes of the networks to compare.


def fully_connected(inputs: int, classes: int) -> Layers:
    """Two hidden layers of 256 and 128 units, each followed by dropout."""
    return (
        ("dense", inputs, 256), ("relu",), ("dropout", 0.5),
        ("dense", 256, 128), ("relu",), ("dropout", 0.5),
        ("dense", 128, classes),
    )


def convolutional(height: int, width: int, classes: int) -> Layers:
    """Two 3x3 convolutions with pooling (16 and 32 channels) and one hidden layer of 128 units."""
    return (
        ("image", 1, height, width),
        ("conv", 1, 16, 3), ("relu",), ("pool",),
        ("conv", 16, 32, 3), ("relu",), ("pool",),
        ("flatten",), ("dense", 32 * (height // 4) * (width // 4), 128), ("relu",), ("dropout", 0.5),
        ("dense", 128, classes),
    )


def curve_fitter(hidden: int = 5) -> Layers:
    """One input, one hidden layer whose units share a single bias, one output."""
    return (("dense_one_bias", 1, hidden), ("relu",), ("dense", hidden, 1))
