"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

The inertia of the LDL' factors of A - sI says how many eigenvalues lie above s. Counts at a
few shifts isolate the eigenvalue of a given number in an interval; Rayleigh quotient
iteration, which converges cubically, then finds it, and counts just below and just above
the result certify its number. The matrix is small (one row per dimension).
"""

import bisect

import numpy as np

EPS = np.finfo(float).eps
# Bunch and Parlett's bound between pivots of one and of two rows.
ALPHA = (1 + 17**0.5) / 8
MOST_STEPS = 60


class Factors:
    """P (A - shift I) P' = L D L' with complete pivoting; D has blocks of one or two rows."""

    def __init__(self, matrix, shift, scale):
        a = matrix - shift * np.eye(len(matrix))
        n = len(a)
        self.order, self.lower, self.blocks = np.arange(n), np.eye(n), []
        self.above, least, k = 0, EPS * scale, 0
        while k < n:
            rest = np.abs(a[k:, k:])
            diagonal = rest.diagonal()
            one = int(diagonal.argmax())
            off = np.tril(rest, -1)
            row, column = divmod(int(off.argmax()), n - k)
            if diagonal[one] >= ALPHA * off[row, column]:
                self.swap(a, k, k + one)
                pivot = a[k, k]
                self.above += pivot > 0
                pivot = pivot if abs(pivot) > least else (least if pivot >= 0 else -least)
                part = a[k + 1 :, k] / pivot
                a[k + 1 :, k + 1 :] -= np.outer(part, a[k + 1 :, k])
                self.lower[k + 1 :, k] = part
                self.blocks.append((k, np.array([[1 / pivot]])))
                k += 1
            else:
                # A block of two has a negative determinant: one eigenvalue above, one below.
                self.swap(a, k, k + column)
                self.swap(a, k + 1, k + row)
                inverse = np.linalg.inv(a[k : k + 2, k : k + 2])
                self.above += 1
                part = a[k + 2 :, k : k + 2] @ inverse
                a[k + 2 :, k + 2 :] -= part @ a[k + 2 :, k : k + 2].T
                self.lower[k + 2 :, k : k + 2] = part
                self.blocks.append((k, inverse))
                k += 2

    def swap(self, a, i, j):
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]
            self.order[[i, j]] = self.order[[j, i]]
            self.lower[[i, j], : min(i, j)] = self.lower[[j, i], : min(i, j)]

    def solve(self, vector):
        x = vector[self.order]
        for k in range(len(x)):
            x[k + 1 :] -= self.lower[k + 1 :, k] * x[k]
        for k, inverse in self.blocks:
            x[k : k + len(inverse)] = inverse @ x[k : k + len(inverse)]
        for k in range(len(x) - 1, -1, -1):
            x[k] -= self.lower[k + 1 :, k] @ x[k + 1 :]
        out = np.empty_like(x)
        out[self.order] = x
        return out


class Slices:
    """Counts of the eigenvalues above the shifts tried so far."""

    def __init__(self, matrix):
        self.matrix = matrix
        radius = np.abs(matrix).sum(axis=1) - np.abs(matrix.diagonal())
        self.scale = float(np.abs(matrix).sum(axis=1).max())
        margin = 4 * EPS * self.scale
        # Gershgorin: all eigenvalues lie between the two ends.
        self.shifts = [float((matrix.diagonal() - radius).min()) - margin, float((matrix.diagonal() + radius).max()) + margin]
        self.counts = [len(matrix), 0]

    def factors(self, shift):
        found = Factors(self.matrix, shift, self.scale)
        at = bisect.bisect_left(self.shifts, shift)
        if at == len(self.shifts) or self.shifts[at] != shift:
            self.shifts.insert(at, shift)
            self.counts.insert(at, found.above)
        return found

    def bracket(self, number):
        """The tightest known interval that holds eigenvalue `number`, and how many it holds."""
        low = max(k for k, c in enumerate(self.counts) if c >= number)
        high = next(k for k in range(low + 1, len(self.counts)) if self.counts[k] < number)
        return self.shifts[low], self.shifts[high], self.counts[low] - self.counts[high]

    def isolate(self, number, width):
        """Halve until the interval holds one eigenvalue, or is no wider than `width`."""
        low, high, held = self.bracket(number)
        while held > 1 and high - low > width:
            self.factors((low + high) / 2)
            low, high, held = self.bracket(number)
        return low, high, held


def orthogonal(vector, found):
    for _ in range(2):
        for other in found:
            vector = vector - (other @ vector) * other
    return vector / np.linalg.norm(vector)


def start_vector(size, number):
    return np.cos(np.arange(1, size + 1) * (number + 0.5))


def eigenpair(slices, number, found):
    """(eigenvalue, vector) of that number from above; `found` holds the vectors before it."""
    matrix, least = slices.matrix, 8 * EPS * slices.scale
    low, high, held = slices.isolate(number, 64 * least)
    for _ in range(MOST_STEPS):
        x = orthogonal(start_vector(len(matrix), number), found)
        middle = slices.factors((low + high) / 2)
        for _ in range(2 if held == 1 else 6):
            x = orthogonal(middle.solve(x), found)
        value = float(x @ matrix @ x)
        inside, before = True, np.inf
        while held == 1:
            residual = float(np.linalg.norm(matrix @ x - value * x))
            inside = low - least <= value <= high + least
            if not inside or residual <= least or (residual >= before / 2 and residual <= 64 * least):
                break
            before = residual
            x = orthogonal(slices.factors(value).solve(x), found)
            value = float(x @ matrix @ x)
        if inside and certified(slices, number, value, x):
            return value, x
        slices.factors((low + high) / 2)
        low, high, held = slices.bracket(number)
    raise ArithmeticError(f"eigenvalue {number} was not certified")


def certified(slices, number, value, x):
    """Fewer than `number` eigenvalues lie just above the value, at least `number` above just below it."""
    residual = float(np.linalg.norm(slices.matrix @ x - value * x))
    margin = max(2 * residual, 64 * EPS * slices.scale)
    if margin > 1e-9 * slices.scale:
        return False
    return slices.factors(value + margin).above < number <= slices.factors(value - margin).above


def leading_eigenpairs(matrix, most):
    """(values, vectors as rows) of the at most `most` largest eigenvalues that are above zero to double precision."""
    if not len(matrix) or not np.abs(matrix).max() > 0:
        return np.zeros(0), np.zeros((0, len(matrix)))
    slices, values, vectors = Slices(matrix), [], []
    for number in range(1, min(most, len(matrix)) + 1):
        value, x = eigenpair(slices, number, vectors)
        if value <= 16 * len(matrix) * EPS * slices.scale:
            break
        values.append(value)
        vectors.append(x)
    return np.array(values), np.array(vectors).reshape(len(vectors), len(matrix))
