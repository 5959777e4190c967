"""A piece vocabulary compiled to a deterministic transducer.

The vocabulary merges the best-scored neighbouring pieces first (leftmost on ties). A
piece sequence is the encoding of its text exactly when every two neighbours are the
encoding of their own concatenation, so the last piece of each prefix follows from the
last pieces of shorter prefixes. A state keeps, for every start that a longer piece could
still reach back to, the text since there, the last piece before it and its count; a
transition carries the change of the number of pieces. Of the piece before a start only
matters which pieces may still follow it, so one piece stands for all that agree in this,
and starts that no piece may follow are left out: some ten thousand states remain. Two
characters that stand side by side in no piece are a hard limit: there the machine starts
anew whatever came before.

Transitions are compiled when a text first asks for them and kept for later texts.
"""

from __future__ import annotations

import bisect

import numpy as np

from likeness.llm.text import only

SPACE = "▁"
# Characters without a piece, by their UTF-8 length, then characters in no longer piece.
UNKNOWN, LONE, FIRST = 0, 4, 5
# A chunk of text between two cuts; the map of a chunk without a hard limit takes its entry state.
CHUNK = 256
MAX_STATES, MAX_FOLLOWERS = 1 << 16, 1 << 15
NEVER = -1e30  # below every score


def machine(path: str) -> "Machine":
    """One machine per worker process."""
    return only(("pieces", path), lambda: Machine(path))


class Machine:
    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.n_pieces = model.get_piece_size()
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(self.n_pieces)]
        self.byte_id = np.full(256, model.unk_id(), np.int32)
        self.ids, self.score = {}, {}
        self.surface = []
        for i in range(self.n_pieces):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.surface.append(bytes([int(piece[3:5], 16)]))
            elif special[i]:
                self.surface.append(" ⁇ ".encode() if model.is_unknown(i) else b"")
            else:
                self.ids[piece], self.score[piece] = i, model.get_score(i)
                self.surface.append(piece.replace(SPACE, " ").encode())
        # What the normaliser does to single characters: a blank becomes the space mark.
        self.starts_with_space = model.normalize("a").startswith(SPACE)
        assert model.normalize("  a \t b ").endswith("▁▁a▁\t▁b▁"), "only models without rewriting rules"
        longer = [p for p in self.ids if len(p) > 1]
        self.beginnings = {p[:k] for p in longer for k in range(1, len(p))}
        self.pairs = {p[k:k + 2] for p in longer for k in range(len(p) - 1)}
        letters = sorted({c for p in longer for c in p})
        assert all(c in self.ids for c in letters), "every character of a longer piece is a piece"
        self.width = FIRST + len(letters)
        self.letter = dict(zip(letters, range(FIRST, self.width)))
        self.char_of = [None] * FIRST + letters
        kinds = np.empty(0x110000, np.uint16)
        for k, (low, high) in enumerate(((0, 0x80), (0x80, 0x800), (0x800, 0x10000), (0x10000, 0x110000))):
            kinds[low:high] = UNKNOWN + k
        self.lone_id = np.full(0x110000, -1, np.int32)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                kinds[ord(piece)] = LONE
                self.lone_id[ord(piece)] = i
        for c, k in self.letter.items():
            kinds[ord(c)] = k
        kinds[ord(" ")] = kinds[ord(SPACE)]
        self.lone_id[ord(" ")] = self.lone_id[ord(SPACE)]
        self.kinds = kinds
        joined = np.zeros((self.width, self.width), bool)
        for a, b in self.pairs:
            joined[self.letter[a], self.letter[b]] = True
        self.limit = ~joined.ravel()  # of two neighbours: a hard limit lies between them
        self.spines()
        self.reset()

    # ---- compilation -------------------------------------------------------------

    def reset(self):
        self.states, self.keys, self.classes, self.stands = {}, [], {}, {}
        self.table = np.full((1024, self.width), -1, np.int32)  # next state * 256 + change of count + 128
        self.last_id, self.last_len = np.zeros(1024, np.int32), np.zeros(1024, np.int32)
        self.start = self.state((("", None, 0),))

    def state(self, key) -> int:
        known = self.states.get(key)
        if known is not None:
            return known
        new = len(self.keys)
        if new == len(self.table):
            self.table = np.concatenate([self.table, np.full_like(self.table, -1)])
            self.last_id, self.last_len = (np.concatenate([a, np.zeros_like(a)]) for a in (self.last_id, self.last_len))
        self.states[key] = new
        self.keys.append(key)
        last = key[-1][1]
        if last is not None:
            self.last_id[new], self.last_len[new] = self.ids.get(last, -1), len(last)
        for k in range(4):  # a character without a piece gives its bytes
            self.table[new, UNKNOWN + k] = (self.start if new else 0) * 256 + 128 + k + 1
        self.table[new, LONE] = (self.start if new else 0) * 256 + 129
        return new

    def spines(self):
        """For every piece, in sorted order, how its own encoding goes: the scores of its
        merges in turn, and its leftmost and rightmost part after each of them."""
        self.sorted = sorted(self.ids)
        self.place = {p: k for k, p in enumerate(self.sorted)}
        n, depth = len(self.sorted), max(map(len, self.sorted))
        self.whole = np.zeros(n, bool)
        self.merge_score = np.full((n, depth + 1), NEVER)
        self.left = np.zeros((n, depth + 1), np.int32)
        self.right = {}
        for k, piece in enumerate(self.sorted):
            parts, scores, ends = list(piece), [], [piece[-1]]
            self.left[k, 0] = self.place[parts[0]]
            while len(parts) > 1:
                best, at = max(((self.score.get(parts[i] + parts[i + 1], NEVER), -i) for i in range(len(parts) - 1)))
                if best == NEVER:
                    break
                parts[-at:2 - at] = [parts[-at] + parts[1 - at]]
                scores.append(best)
                ends.append(parts[-1])
                self.left[k, len(scores)] = self.place[parts[0]]
            self.merge_score[k, :len(scores)] = scores
            self.whole[k] = len(parts) == 1
            self.right[piece] = (np.array(scores + [NEVER]), ends)
        self.range_of = {}
        for s in self.beginnings:
            self.range_of[s] = (bisect.bisect_left(self.sorted, s), bisect.bisect_left(self.sorted, s + chr(0x10FFFF)))
        self.across = np.full((depth + 1, n), NEVER)
        self.follow, self.joins = {}, {}
        self.met = np.zeros(n, bool)

    def joined(self, part: str):
        """(places of the parts that may stand right of ``part`` in a merge, scores of the merges)."""
        known = self.joins.get(part)
        if known is None:
            low, high = self.range_of.get(part, (0, 0))
            found = [(self.place[p[len(part):]], self.score[p]) for p in self.sorted[low:high]
                     if p[len(part):] in self.place]
            known = np.array([f[0] for f in found], np.int64), np.array([f[1] for f in found], np.float64)
            self.joins[part] = known
        return known

    def followers(self, before: str | None, letter: str) -> np.ndarray:
        """Which pieces that begin with ``letter`` may follow ``before``: no merge across the
        limit ever comes first while both sides merge on their own."""
        known = self.follow.get((before, letter))
        if known is not None:
            return known
        low, high = self.range_of.get(letter, (0, 0))
        if high == low:  # the letter alone
            low = self.place[letter]
            high = low + 1
        good = self.whole[low:high].copy()
        if before is not None and before[-1] + letter in self.pairs:
            scores, ends = self.right[before]
            used = []
            for i, part in enumerate(ends):
                places, values = self.joined(part)
                self.across[i, places] = values
                self.met[places] = True
                used.append((i, places))
            rows = np.flatnonzero(good & self.met[self.left[low:high]].any(axis=1))
            i, j = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
            while len(rows):
                own, other = scores[i], self.merge_score[low + rows, j]
                cross = self.across[i, self.left[low + rows, j]]
                bad = (cross > own) & (cross >= other) & (cross > NEVER)
                good[rows[bad]] = False
                going = ~bad & ((own > NEVER) | (other > NEVER))
                ahead = own >= other
                rows, i, j = rows[going], (i + ahead)[going], (j + ~ahead)[going]
            for i, places in used:
                self.across[i, places] = NEVER
                self.met[places] = False
        self.follow[before, letter] = good
        return good

    def valid(self, before: str | None, piece: str) -> bool:
        """Whether the arc ``piece`` may follow the piece ``before`` (its weight is finite)."""
        low = self.range_of.get(piece[0], (self.place[piece[0]],))[0]
        return bool(self.followers(before, piece[0])[self.place[piece] - low])

    def stand_in(self, since: str, before: str | None):
        """(the piece that stands for ``before`` among all with the same followers from
        ``since`` on, whether there are any)."""
        known = self.stands.get((since, before))
        if known is None:
            low, high = self.range_of[since]
            first = self.range_of[since[0]][0]
            longer = self.followers(before, since[0])[low - first:high - first]
            if self.sorted[low] == since:
                longer = longer[1:]
            known = (self.classes.setdefault((since, longer.tobytes()), before), bool(longer.any()))
            self.stands[since, before] = known
        return known

    def step(self, key, char: str):
        """(next key, change of the count) on reading a character of some longer piece."""
        last = key[-1][1]
        if last is not None and last[-1] + char not in self.pairs:
            key = (("", None, 0),)
        piece, count = None, 0
        for since, before, behind in key:  # the longest piece is tried first
            text = since + char
            if text in self.ids and self.valid(before, text):
                piece, count = text, behind + 1
                break
        kept = []
        for since, before, behind in key:
            if since + char in self.beginnings:
                stand, any_ = self.stand_in(since + char, before)
                if any_:
                    kept.append((since + char, stand, behind - count))
        return (*kept, ("", piece, 0)), count

    def compile(self, codes: np.ndarray):
        for code in np.unique(codes):
            at, kind = divmod(int(code), self.width)
            key, change = self.step(self.keys[at], self.char_of[kind])
            self.table[at, kind] = self.state(key) * 256 + change + 128

    # ---- texts -------------------------------------------------------------------

    def symbols(self, points: np.ndarray, limits: np.ndarray):
        """(code points, row limits) after the normaliser: a space mark before every text that isn't empty."""
        if not self.starts_with_space:
            return points, limits
        filled = np.flatnonzero(np.diff(limits))
        shift = np.concatenate(([0], np.cumsum(np.diff(limits) > 0)))
        return np.insert(points, limits[filled], ord(SPACE)), limits + shift

    def cuts(self, kind: np.ndarray, limits: np.ndarray):
        """(chunk starts, chunk lengths, whether a chunk takes its entry state from the one before)."""
        n = len(kind)
        if n == 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        hard = np.zeros(n + 1, bool)
        hard[1:n] = self.limit[kind[:-1].astype(np.int32) * self.width + kind[1:]]
        rows = limits[:-1][np.diff(limits) > 0]
        hard[rows] = True
        hard[n] = True
        places = np.flatnonzero(hard)
        wanted = np.arange(0, n, CHUNK)
        soft = places[np.searchsorted(places, wanted)]
        starts = np.unique(np.concatenate([rows, soft[soft < n]]))
        ends = np.append(starts[1:], n)
        long = np.flatnonzero(ends - starts > 4 * CHUNK)
        if len(long):
            inner = np.concatenate([np.arange(starts[k] + 2 * CHUNK, ends[k], 2 * CHUNK) for k in long])
            starts = np.union1d(starts, inner)
        return starts, np.diff(np.append(starts, n)), ~hard[starts]

    def walk(self, kind, starts, lengths, entry, path=None):
        """Chunk maps at the given entry states: (exit states, piece counts). All chunks advance together."""
        order = np.argsort(-lengths, kind="stable")
        at, state = starts[order], entry[order].astype(np.int32)
        length = lengths[order]
        total = np.zeros(len(at), np.int64)
        width = np.int32(self.width)
        steps = int(length[0]) if len(length) else 0
        active = len(length) - np.searchsorted(length[::-1], np.arange(steps), "right")
        flat = self.table.reshape(-1)
        for k in range(steps):
            n = active[k]
            place = at[:n] + k
            code = state[:n] * width + kind[place]
            to = flat[code]
            if to.min() < 0:
                self.compile(code[to < 0])
                flat = self.table.reshape(-1)
                to = flat[code]
            state[:n] = to >> 8
            total[:n] += (to & 255) - 128
            if path is not None:
                path[place] = state[:n]
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return state[back], total[back]

    def maps(self, kind, starts, lengths, open_):
        """Nodes (chunk, entry state) closed under what any chunk map leads to."""
        chunk, entry = np.arange(len(starts)), np.full(len(starts), self.start, np.int64)
        exits, counts = self.walk(kind, starts, lengths, entry)
        nodes = {(c, self.start): c for c in np.flatnonzero(open_).tolist()}
        fresh = np.flatnonzero(np.append(open_[1:], False))
        while len(fresh):
            asked = {(int(chunk[i]) + 1, int(exits[i])) for i in fresh} - nodes.keys()
            if not asked:
                break
            asked = sorted(asked)
            nodes.update(zip(asked, range(len(chunk), len(chunk) + len(asked))))
            more = np.array(asked, np.int64)
            out, n = self.walk(kind, starts[more[:, 0]], lengths[more[:, 0]], more[:, 1])
            first = len(chunk)
            chunk, entry = np.concatenate([chunk, more[:, 0]]), np.concatenate([entry, more[:, 1]])
            exits, counts = np.concatenate([exits, out]), np.concatenate([counts, n])
            follows = np.append(open_[1:], False)[more[:, 0]]
            fresh = first + np.flatnonzero(follows)
        return chunk, entry, exits, counts, nodes

    def tidy(self):
        """Between slices: forget all states once there are too many."""
        if len(self.keys) > MAX_STATES:
            self.reset()
        if len(self.follow) > MAX_FOLLOWERS:
            self.follow = {}

    def count(self, points: np.ndarray, limits: np.ndarray) -> np.ndarray:
        """Pieces of every text. Chunk maps are composed by doubling: after round r a
        node's map covers 2**r chunks."""
        self.tidy()
        points, limits = self.symbols(points, limits)
        kind = self.kinds[points]
        starts, lengths, open_ = self.cuts(kind, limits)
        totals = np.zeros(len(limits) - 1, np.int64)
        if not len(starts):
            return totals
        chunk, _, exits, counts, nodes = self.maps(kind, starts, lengths, open_)
        if open_.any():
            none = len(chunk)
            after = np.full(none + 1, none, np.int64)
            for i in np.flatnonzero(np.append(open_[1:], False)[chunk]):
                after[i] = nodes[int(chunk[i]) + 1, int(exits[i])]
            counts = np.append(counts, 0)
            while (after != none).any():
                counts = counts + counts[after]
                after = after[after]
        roots = np.flatnonzero(~open_)
        row = np.searchsorted(limits, starts[roots], "right") - 1
        np.add.at(totals, row, counts[roots])
        return totals

    def encode(self, points: np.ndarray, limits: np.ndarray):
        """(piece ids of all texts, row limits in them): the path of least weight, read
        backwards from each hard limit along the last pieces of its prefixes."""
        self.tidy()
        points, limits = self.symbols(points, limits)
        kind = self.kinds[points]
        starts, lengths, open_ = self.cuts(kind, limits)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(limits), np.int64)
        path = np.zeros(len(kind), np.int32)
        if open_.any():
            chunk, _, exits, _, nodes = self.maps(kind, starts, lengths, open_)
            entry = np.full(len(starts), self.start, np.int64)
            for c in np.flatnonzero(open_).tolist():
                at = c - 1 if not open_[c - 1] else nodes[c - 1, int(entry[c - 1])]
                entry[c] = exits[at]
        else:
            entry = np.full(len(starts), self.start, np.int64)
        self.walk(kind, starts, lengths, entry, path)
        ids, size = self.last_id[path], self.last_len[path]
        single = size == 0  # the machine is at its start: the character stood alone
        ids[single], size[single] = self.lone_id[points[single]], 1
        heads = starts[~open_]
        at = np.append(heads[1:], len(kind)) - 1
        ends = np.zeros(len(kind), bool)
        while len(at):
            ends[at] = True
            at = at - size[at]
            going = at >= heads
            at, heads = at[going], heads[going]
        marked = np.flatnonzero(ends)
        found, rows = ids[marked], np.searchsorted(marked, limits)
        missing = found < 0
        if missing.any():
            spelt = points[marked[missing]].astype("<u4").tobytes().decode("utf-32-le").encode("utf-8")
            n = np.ones(len(found), np.int64)
            alone = points[marked[missing]]
            n[missing] = 1 + (alone > 0x7F) + (alone > 0x7FF) + (alone > 0xFFFF)
            into = np.concatenate(([0], np.cumsum(n)))
            spread = np.repeat(found, n)
            spread[spread < 0] = self.byte_id[np.frombuffer(spelt, np.uint8)]
            found, rows = spread, into[rows]
        return found, rows
