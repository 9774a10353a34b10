"""What the operators must find, worked out in plain Python over a small corpus."""


def words(t, fold=False):
    raw = (t or "").encode()
    return (raw.lower() if fold else raw).split()


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def brute_components(corpus, width, percent):
    sets = {}
    for i, t, _, _ in corpus:
        w = words(t, True)
        k = min(width, len(w))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if w else set()
    root = {i: i for i in sets}

    def find(x):
        return x if root[x] == x else find(root[x])

    for i in sets:
        for j in sets:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def kept_words(corpus, width):
    first, result = {}, {}
    for i, t, _, _ in sorted(corpus):
        w = words(t)
        covered = set()
        for j in range(len(w) - width + 1):
            if first.setdefault(tuple(w[j : j + width]), i) < i:
                covered |= set(range(j, j + width))
        result[i] = (len(w), len(covered), b" ".join(x for j, x in enumerate(w) if j not in covered).decode())
    return result
