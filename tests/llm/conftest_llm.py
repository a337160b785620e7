"""Plain helpers of these tests."""

import os

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


def components_of(nodes, pairs):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}
