from collections import Counter

SMALL = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def swept(ids, edges, order, most):
    """In-place label propagation, one vertex after another in the given order, and whether it settled."""
    near = {i: [] for i in ids}
    for a, b in edges:
        if a in near and b in near:
            near[a].append(b)
            near[b].append(a)
    label = {i: i for i in ids}
    for _ in range(most):
        before = dict(label)
        for i in order:
            votes = Counter(label[x] for x in near[i])
            if votes:
                label[i] = max(votes, key=lambda c: (votes[c], c == label[i], -c))
        if label == before:
            return label, True
    return label, False
