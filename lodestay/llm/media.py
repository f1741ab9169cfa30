"""Media columns in progressive JPEG: bytes kept losslessly in quantised coefficients, and decoding to full-resolution RGB.

Writing: a payload's bytes are signed 8-bit coefficients, 64 a block in zigzag order, quantised by one, in a 4:2:0 picture
(all luma blocks by rows, then the two chroma planes). Scans: DC and AC bands at point transform 1 (spectral selection),
then one refinement each (successive approximation). A restart marker follows every unit, and a comment holds the length.

Reading: any Huffman-coded progressive JPEG of 8-bit samples. Scans are accumulated in coefficient arrays; the stretches
between restart markers are decoded side by side in numpy, those of all pictures of a batch together (a file without
restart markers is one stretch, right but slow). The inverse transform is exact integer arithmetic, so a picture's samples
don't depend on its batch; chroma is upsampled by repetition, and RGB tensors are stored as bytes with height and width.

A very long text is one picture, held whole in its task with its coefficients and planes (the format's sides allow 6 GB).
Null text counts as empty: one block of zeros. Repeated rows get equal media; other columns pass through, those named like
an added one are replaced; an empty table gives no rows. No row moves between tasks.
"""

from __future__ import annotations

import hashlib
import math
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lodestay.llm.common import as_bytes, documents, slices

LANES = 1 << 15  # stretches decoded, or blocks encoded, side by side
BATCH = 2 << 20


@cache
def zigzag() -> np.ndarray:
    """Place in the 8 x 8 square (by rows) of each coefficient in zigzag order."""
    walk = sorted(((i + j, (j if (i + j) % 2 == 0 else i), i * 8 + j) for i in range(8) for j in range(8)))
    return np.array([x[2] for x in walk])


def canonical(counts: list[int], symbols: list[int]) -> list[tuple[int, int, int]]:
    """(symbol, code, length) of a Huffman table given as codes of each length and symbols in order."""
    out, code, at = [], 0, 0
    for length, n in enumerate(counts, 1):
        for s in symbols[at : at + n]:
            out.append((s, code, length))
            code += 1
        at += n
        code <<= 1
    return out


@cache
def own_tables() -> dict[str, tuple[list[int], list[int]]]:
    """Tables of our files: DC categories in four bits; for AC, sizes 6 and 5 without a run are shortest (letters, blanks)."""
    dc = ([0, 0, 0, 12] + [0] * 12, list(range(12)))
    first = [0x06, 0x05, 0x00]
    rest = [r << 4 | s for r in range(16) for s in range(11) if (s or r in (0, 15)) and (r << 4 | s) not in first]
    return {"dc": dc, "ac": ([1, 1, 1, 0, 0, 0, 0, 0, 0, 0, len(rest), 0, 0, 0, 0, 0], first + rest)}


@cache
def own_codes(kind: str) -> tuple[np.ndarray, np.ndarray]:
    code, length = np.zeros(256, np.int64), np.zeros(256, np.int64)
    for s, c, n in canonical(*own_tables()[kind]):
        code[s], length[s] = c, n
    return code, length


@cache
def bit_sizes() -> np.ndarray:
    return np.array([n.bit_length() for n in range(4096)], np.int64)


def to_stream(lane: np.ndarray, value: np.ndarray, length: np.ndarray, lanes: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes (of up to 24 bits, in order of their lanes) to bytes; each lane filled up with ones: bytes, lane lengths."""
    bits = np.bincount(lane, weights=length, minlength=lanes).astype(np.int64)
    size = (bits + 7) >> 3
    start = np.concatenate(([0], np.cumsum(size)))
    ahead = np.cumsum(length) - length
    lane_bits = np.concatenate(([0], np.cumsum(bits)))[:-1]
    at = start[:-1][lane] * 8 + ahead - lane_bits[lane]
    word = value << (32 - (at & 7) - length)
    byte = at >> 3
    total = int(start[-1])
    out = np.zeros(total + 4)
    for k in range(4):
        out += np.bincount(byte + k, weights=(word >> (24 - 8 * k)) & 255, minlength=total + 4)[: total + 4]
    made = out[:total].astype(np.uint8)
    made[start[1:] - 1] |= ((1 << (size * 8 - bits)) - 1).astype(np.uint8)
    return made, size


def with_markers(data: np.ndarray, size: np.ndarray, nth: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stuffs FF bytes and puts a restart marker after each lane but the last of its scan: bytes, lane lengths."""
    stuffed = data == 255
    lane = np.repeat(np.arange(len(size)), size)
    grown = size + np.bincount(lane, weights=stuffed, minlength=len(size)).astype(np.int64)
    full = grown + 2 * ~last
    starts = np.cumsum(full) - full
    out = np.zeros(int(full.sum()), np.uint8)
    shift = np.cumsum(stuffed) - stuffed
    out[np.arange(len(data)) + shift + 2 * np.concatenate(([0], np.cumsum(~last)))[:-1][lane]] = data
    ends = (starts + grown)[~last]
    out[ends] = 255
    out[ends + 1] = 208 + nth[~last] % 8
    return out, full


def code_ac_first(blocks: np.ndarray, lo: int, hi: int, al: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    code, length = own_codes("ac")
    band = blocks[:, lo : hi + 1].astype(np.int64)
    v = np.sign(band) * (np.abs(band) >> al)
    row, k = np.nonzero(v)
    v = v[row, k]
    before = np.concatenate(([-1], k[:-1]))
    before[np.concatenate(([True], row[1:] != row[:-1]))[: len(row)]] = -1
    run = k - before - 1
    long_runs = run >> 4
    last = np.full(len(blocks), -1)
    last[row] = k  # later writes win
    ends = last < hi - lo
    eobs = np.cumsum(ends) - ends
    nz_at = np.cumsum(long_runs + 1) - 1 + eobs[row]
    per_row = np.bincount(row, weights=long_runs + 1, minlength=len(blocks)).astype(np.int64)
    eob_at = (np.cumsum(per_row) + eobs)[ends]
    total = int(per_row.sum() + ends.sum())
    lane = np.repeat(np.arange(len(blocks)), per_row + ends)
    value, bits = np.full(total, code[0xF0]), np.full(total, length[0xF0])
    s = bit_sizes()[np.abs(v)]
    symbol = (run & 15) << 4 | s
    value[nz_at] = code[symbol] << s | np.where(v > 0, v, v + (1 << s) - 1)
    bits[nz_at] = length[symbol] + s
    value[eob_at], bits[eob_at] = code[0], length[0]
    return lane, value, bits


def refine_block(band: list[int], al: int) -> list[tuple[int, int]]:
    """Codes of one block's refinement that has new coefficients."""
    code, length = own_codes("ac")
    out, run, fixes = [], 0, []
    last_new = max(k for k, c in enumerate(band) if abs(c) >> al == 1)
    for k, c in enumerate(band):
        a = abs(c) >> al
        if a > 1:
            fixes.append((a & 1, 1))
        elif a == 1:
            out += [(int(code[run << 4 | 1]) << 1 | (c > 0), int(length[run << 4 | 1]) + 1), *fixes]
            run, fixes = 0, []
        else:
            run += 1
            if run == 16 and k < last_new:
                out += [(int(code[0xF0]), int(length[0xF0])), *fixes]
                run, fixes = 0, []
    if run or fixes:
        out += [(int(code[0]), int(length[0])), *fixes]
    return out


def code_ac_refine(blocks: np.ndarray, lo: int, hi: int, al: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    code, length = own_codes("ac")
    band = blocks[:, lo : hi + 1].astype(np.int64)
    a = np.abs(band) >> al
    plain = ~(a == 1).any(axis=1)
    fix = (a > 1) & plain[:, None]
    row, k = np.nonzero(fix)
    heads = np.flatnonzero(plain)
    lane = np.concatenate((heads, row))
    value = np.concatenate((np.full(len(heads), code[0]), a[row, k] & 1))
    bits = np.concatenate((np.full(len(heads), length[0]), np.ones(len(row), np.int64)))
    more = [(i, v, n) for i in np.flatnonzero(~plain).tolist() for v, n in refine_block(band[i].tolist(), al)]
    if more:
        lane, value, bits = (np.concatenate((x, np.array(y, np.int64))) for x, y in zip((lane, value, bits), zip(*more, strict=True), strict=True))
    order = np.argsort(lane, kind="stable")
    return lane[order], value[order], bits[order]


def code_dc_first(values: np.ndarray, comps: np.ndarray, al: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """values: (units, blocks of a unit); comps: the component of each block of a unit; predictions start at each unit."""
    code, length = own_codes("dc")
    v = values.astype(np.int64) >> al
    diff = v.copy()
    for i in range(1, v.shape[1]):
        if comps[i] == comps[i - 1]:
            diff[:, i] = v[:, i] - v[:, i - 1]
    s = bit_sizes()[np.abs(diff)]
    value = code[s] << s | np.where(diff > 0, diff, diff + (1 << s) - 1)
    return np.repeat(np.arange(len(v)), v.shape[1]), value.ravel(), (length[s] + s).ravel()


#: Scans of our files: components, first and last coefficient, high and low bit.
SCRIPT = [((0, 1, 2), 0, 0, 0, 1), ((0,), 1, 5, 0, 1), ((0,), 6, 63, 0, 1), ((1,), 1, 63, 0, 1), ((2,), 1, 63, 0, 1), ((0, 1, 2), 0, 0, 1, 0), ((0,), 1, 63, 1, 0), ((1,), 1, 63, 1, 0), ((2,), 1, 63, 1, 0)]


def grid(blocks: int) -> tuple[int, int]:
    """Columns and rows of 16 x 16 units that hold so many blocks, six a unit."""
    units = -(-blocks // 6)
    wide = math.isqrt(units - 1) + 1
    return wide, -(-units // wide)


def segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 255, marker, len(body) + 2) + body


def header(wide: int, high: int, payload: int) -> bytes:
    if max(wide, high) > 4095:
        raise ValueError("a payload of more than 6 GB doesn't fit a JPEG")
    frame = struct.pack(">BHHB", 8, 16 * high, 16 * wide, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])
    tables = b"".join(bytes([n, *own_tables()[k][0], *own_tables()[k][1]]) for k, n in (("dc", 0x00), ("ac", 0x10)))
    return b"\xff\xd8" + segment(0xFE, struct.pack(">Q", payload)) + segment(0xDB, bytes([0] + [1] * 64)) + segment(0xC2, frame) + segment(0xC4, tables) + segment(0xDD, struct.pack(">H", 1))


def encode(payloads: list[bytes]) -> list[bytes]:
    """Each payload (a positive multiple of 64 bytes) as a progressive JPEG."""
    grids = [grid(len(p) // 64) for p in payloads]
    units = np.array([w * h for w, h in grids])
    first = np.concatenate(([0], np.cumsum(6 * units)))
    coef = np.zeros((int(first[-1]), 64), np.int8)
    for p, at in zip(payloads, first.tolist(), strict=False):
        coef[at : at + len(p) // 64] = np.frombuffer(p, np.int8).reshape(-1, 64)
    files = [[header(w, h, len(p))] for (w, h), p in zip(grids, payloads, strict=True)]
    planes = [np.concatenate([np.arange(a, b) for a, b in zip(first[:-1] + lo * units, first[:-1] + hi * units, strict=True)]) for lo, hi in ((0, 4), (4, 5), (5, 6))]
    # luma blocks of each unit, by rows of the plane
    corner = np.concatenate([a + (np.arange(h)[:, None] * 4 * w + np.arange(w) * 2).ravel() for (w, h), a in zip(grids, first.tolist(), strict=False)])
    wide = np.repeat([2 * w for w, _ in grids], units)
    mcu = np.stack([corner, corner + 1, corner + wide, corner + wide + 1, planes[1], planes[2]], axis=1)
    for comps, lo, hi, ah, al in SCRIPT:
        rows = mcu if lo == 0 else planes[comps[0]]
        count = units if lo == 0 else units * (4 if comps == (0,) else 1)
        ends = np.cumsum(count)
        nth = np.arange(len(rows)) - np.repeat(ends - count, count)
        last = np.zeros(len(rows), bool)
        last[ends - 1] = True
        parts, sizes = [], []
        for i in range(0, len(rows), LANES):
            take = rows[i : i + LANES]
            if lo == 0 and ah == 0:
                made = code_dc_first(coef[take, 0], np.array([0, 0, 0, 0, 1, 2]), al)
            elif lo == 0:
                bit = (coef[take, 0].astype(np.int64) >> al & 1).ravel()
                made = np.repeat(np.arange(len(take)), 6), bit, np.ones(len(bit), np.int64)
            else:
                made = (code_ac_refine if ah else code_ac_first)(coef[take], lo, hi, al)
            data, size = with_markers(*to_stream(*made, len(take)), nth[i : i + LANES], last[i : i + LANES])
            parts.append(data.tobytes())
            sizes.append(size)
        stream = b"".join(parts)
        cuts = np.concatenate(([0], np.cumsum(np.concatenate(sizes))[ends - 1])).tolist()
        head = segment(0xDA, bytes([len(comps), *[x for c in comps for x in (c + 1, 0)], lo, hi, ah << 4 | al]))
        for f, a, b in zip(files, cuts[:-1], cuts[1:], strict=True):
            f += [head, stream[a:b]]
    return [b"".join([*f, b"\xff\xd9"]) for f in files]


@dataclass
class Component:
    h: int
    v: int
    table: int
    first: int = 0  # of its blocks in the batch's coefficients
    across: int = 0  # blocks in a stored row, filled up to whole units
    down: int = 0
    own_across: int = 0  # blocks that samples of the picture reach
    own_down: int = 0


@dataclass
class Picture:
    data: bytes
    comment: bytes = b""
    width: int = 0
    height: int = 0
    comps: dict[int, Component] = field(default_factory=dict)
    quant: dict[int, np.ndarray] = field(default_factory=dict)
    scans: list[tuple] = field(default_factory=list)  # (components, lo, hi, ah, al, tables, restart, start, end)


def parse(data: bytes) -> Picture:
    """The segments of a progressive JPEG."""
    pic = Picture(data)
    raw = np.frombuffer(data, np.uint8)
    marks = np.flatnonzero(raw[:-1] == 255)
    after = raw[marks + 1]
    marks = marks[(after != 0) & ((after < 208) | (after > 215)) & (after != 255)]
    huff: dict[int, bytes] = {}
    at, restart = 2, 0
    if data[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG")
    while at < len(data) - 1:
        if data[at] != 255:
            raise ValueError(f"no marker at {at}")
        kind = data[at + 1]
        if kind == 255:
            at += 1
            continue
        if kind == 0xD9:
            break
        (n,) = struct.unpack_from(">H", data, at + 2)
        body = data[at + 4 : at + 2 + n]
        at += 2 + n
        if kind == 0xFE:
            pic.comment = body
        elif kind == 0xDB:
            while body:
                wide = body[0] >> 4
                size = 64 * (1 + wide)
                pic.quant[body[0] & 15] = np.frombuffer(body[1 : 1 + size], ">u2" if wide else np.uint8).astype(np.int64)
                body = body[1 + size :]
        elif kind == 0xC2:
            bits, pic.height, pic.width, count = struct.unpack_from(">BHHB", body)
            if bits != 8 or count not in (1, 3):
                raise ValueError("8-bit samples of one or three components are read")
            for i in range(count):
                c, hv, q = body[6 + 3 * i : 9 + 3 * i]
                pic.comps[c] = Component(hv >> 4, hv & 15, q)
        elif 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
            raise ValueError("not a progressive Huffman-coded JPEG")
        elif kind == 0xC4:
            while body:
                n = sum(body[1:17])
                huff[body[0]] = body[1 : 17 + n]
                body = body[17 + n :]
        elif kind == 0xDD:
            (restart,) = struct.unpack(">H", body)
        elif kind == 0xDA:
            n = body[0]
            ids = [(body[1 + 2 * i], body[2 + 2 * i]) for i in range(n)]
            lo, hi, a = body[1 + 2 * n : 4 + 2 * n]
            end = int(marks[np.searchsorted(marks, at)])
            tables = tuple(huff.get(t >> 4 if lo == 0 else (t & 15) | 16, b"") for _, t in ids)
            pic.scans.append((tuple(c for c, _ in ids), lo, hi, a >> 4, a & 15, tables, restart, at, end))
            at = end
    return pic


@cache
def lookup(table: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Symbol and length for every 16 bits that may follow."""
    symbol, length = np.zeros(1 << 16, np.int64), np.full(1 << 16, 16, np.int64)
    for s, code, n in canonical(list(table[:16]), list(table[16:])):
        a = code << (16 - n)
        symbol[a : a + (1 << (16 - n))], length[a : a + (1 << (16 - n))] = s, n
    return symbol, length


class Bits:
    """Bytes without stuffing; many places are read at once."""

    def __init__(self, data: np.ndarray):
        d = np.concatenate((data, np.zeros(8, np.uint8))).astype(np.int64)
        self.window = d[:-3] << 24 | d[1:-2] << 16 | d[2:-1] << 8 | d[3:]
        self.data = np.concatenate((data, np.zeros(16, np.uint8)))

    def peek(self, at: np.ndarray) -> np.ndarray:
        return self.window[np.minimum(at >> 3, len(self.window) - 1)] >> (16 - (at & 7)) & 0xFFFF

    def take(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        return self.peek(at) >> (16 - n)


def stretches(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entropy-coded bytes of several scans without stuffing and restart markers, where each stretch starts, and how many each scan has."""
    raw = np.concatenate(parts)
    begins = np.cumsum([0, *map(len, parts)])
    ff = np.flatnonzero(raw[:-1] == 255)
    after = raw[ff + 1]
    restarts = ff[(after >= 208) & (after <= 215)]
    drop = np.concatenate((ff[after == 0] + 1, restarts, restarts + 1))
    keep = np.ones(len(raw), bool)
    keep[drop] = False
    starts = np.sort(np.concatenate((begins[:-1], restarts + 2)))
    drop.sort()
    return raw[keep], starts - np.searchsorted(drop, starts), np.diff(np.searchsorted(starts, begins))


@dataclass
class Lanes:
    """Stretches of the same kind of scan: start bit, and first place and number of their blocks in order."""

    bits: Bits
    start: np.ndarray
    first: np.ndarray
    count: np.ndarray
    order: np.ndarray  # rows of the coefficients, in scan order
    comp: np.ndarray  # component of each, for DC

    def part(self, i: int) -> Lanes:
        s = slice(i, i + LANES)
        return Lanes(self.bits, self.start[s], self.first[s], self.count[s], self.order, self.comp)


def extend(v: np.ndarray, s: np.ndarray) -> np.ndarray:
    return np.where(v < (1 << np.maximum(s - 1, 0)), v - (1 << s) + 1, v)


def read_dc_first(x: Lanes, coef: np.ndarray, tables: tuple[bytes, ...], al: int) -> None:
    at, pred = x.start.copy(), np.zeros((len(x.start), len(tables)), np.int64)
    looks = [lookup(t) for t in tables]
    for b in range(int(x.count.max(initial=0))):
        on = np.flatnonzero(x.count > b)
        place = x.first[on] + b
        comp = x.comp[place]
        head = x.bits.peek(at[on])
        s, n = (np.choose(comp, [look[i][head] for look in looks]) for i in (0, 1))
        v = extend(x.bits.take(at[on] + n, s), s)
        at[on] += n + s
        pred[on, comp] += v
        coef[x.order[place], 0] = pred[on, comp] << al


def read_dc_refine(x: Lanes, coef: np.ndarray, al: int) -> None:
    for b in range(int(x.count.max(initial=0))):
        on = np.flatnonzero(x.count > b)
        coef[x.order[x.first[on] + b], 0] |= (x.bits.take(x.start[on] + b, np.int64(1)) << al).astype(coef.dtype)


def read_ac_first(x: Lanes, coef: np.ndarray, table: bytes, lo: int, hi: int, al: int) -> None:
    symbol, length = lookup(table)
    lane = np.arange(len(x.start))
    at, b, k = x.start.copy(), np.zeros(len(lane), np.int64), np.full(len(lane), lo)
    first, count = x.first, x.count
    while len(lane):
        head = x.bits.peek(at)
        s, n = symbol[head], length[head]
        at = at + n
        r, s = s >> 4, s & 15
        put = s > 0
        v = extend(x.bits.take(at, s), s)
        k = k + np.where(put, r, 0)
        i = np.flatnonzero(put & (k <= hi))
        coef[x.order[first[i] + b[i]], k[i]] = v[i] << al
        at = at + s
        k = k + np.where(put, 1, np.where(r == 15, 16, 0))
        over = ~put & (r < 15)
        if over.any():
            more = np.where(over, r, 0)
            b = b + np.where(over, (1 << more) - 1 + x.bits.take(at, more), 0)
            at = at + more
        ended = over | (k > hi)
        b, k = b + ended, np.where(ended, lo, k)
        if ended.any():
            on = b < count
            if not on.all():
                lane, at, b, k, first, count = (y[on] for y in (lane, at, b, k, first, count))


def read_ac_refine(x: Lanes, coef: np.ndarray, table: bytes, lo: int, hi: int, al: int) -> None:
    symbol, length = lookup(table)
    one = 1 << al
    # stretches of one block that begin with an end of block: all their bits at once
    head = x.bits.peek(x.start)
    easy = (x.count == 1) & (symbol[head] == 0)
    i = np.flatnonzero(easy)
    if len(i):
        rows = x.order[x.first[i]]
        band = coef[rows, lo : hi + 1]
        old = band != 0
        places = (x.start[i] + length[head[i]])[:, None] + np.cumsum(old, axis=1, dtype=np.int64) - 1
        bit = x.bits.data[np.minimum(places >> 3, len(x.bits.data) - 1)] >> (7 - (places & 7)).astype(np.uint8) & 1
        band = band + np.where(old & (bit == 1), np.where(band > 0, one, -one), 0).astype(coef.dtype)
        coef[rows, lo : hi + 1] = band
    on = np.flatnonzero(~easy)
    at, first, count = x.start[on].copy(), x.first[on], x.count[on]
    b, k = np.zeros(len(on), np.int64), np.full(len(on), lo)
    run, new, eob = np.full(len(on), -1), np.zeros(len(on), np.int64), np.zeros(len(on), np.int64)  # run -1: a symbol is due
    while len(at):
        due = np.flatnonzero((run < 0) & (eob == 0))
        if len(due):
            head = x.bits.peek(at[due])
            s, n = symbol[head], length[head]
            r, s = s >> 4, s & 15
            a = at[due] + n
            over = (s == 0) & (r < 15)
            more = np.where(over, r, np.where(s > 0, 1, 0))
            got = x.bits.take(a, more)
            eob[due] = np.where(over, (1 << np.where(over, r, 0)) + got, 0)
            new[due] = np.where(s > 0, np.where(got == 1, one, -one), 0)
            run[due] = np.where(over, -1, r)
            at[due] = a + more
        rows = x.order[first + b]
        c = coef[rows, k]
        old = c != 0
        i = np.flatnonzero(old)
        if len(i):
            bit = x.bits.take(at[i], np.int64(1))
            coef[rows[i], k[i]] = c[i] + np.where(bit == 1, np.where(c[i] > 0, one, -one), 0)
            at[i] += 1
        zero = ~old & (eob == 0)
        i = np.flatnonzero(zero & (run == 0))
        coef[rows[i], k[i]] = new[i]
        run = np.where(zero, run - 1, run)
        k = k + 1
        ended = k > hi
        if ended.any():
            run = np.where(ended, -1, run)
            eob = np.where(ended & (eob > 0), eob - 1, eob)
            b, k = b + ended, np.where(ended, lo, k)
            go = b < count
            if not go.all():
                at, first, count, b, k, run, new, eob = (y[go] for y in (at, first, count, b, k, run, new, eob))


def coefficients(pics: list[Picture]) -> np.ndarray:
    """All scans of all pictures, accumulated: a row of 64 in zigzag order for each block."""
    total = 0
    for p in pics:
        hm, vm = max(c.h for c in p.comps.values()), max(c.v for c in p.comps.values())
        wide, high = -(-p.width // (8 * hm)), -(-p.height // (8 * vm))
        for c in p.comps.values():
            c.first, c.across, c.down = total, wide * c.h, high * c.v
            c.own_across, c.own_down = -(--(-p.width * c.h // hm) // 8), -(--(-p.height * c.v // vm) // 8)
            total += c.across * c.down
    coef = np.zeros((total, 64), np.int16)
    for nth in range(max((len(p.scans) for p in pics), default=0)):
        groups: dict[tuple, list] = defaultdict(list)
        for p in pics:
            if nth < len(p.scans):
                groups[p.scans[nth][1:6]].append((p, p.scans[nth]))
        for (lo, hi, ah, al, tables), members in groups.items():
            data, starts, found = stretches([np.frombuffer(p.data, np.uint8)[scan[7] : scan[8]] for p, scan in members])
            order, kinds, wanted, pers = [], [], [], []
            for p, (ids, *_, restart, _, _) in members:
                rows, kind, unit = scan_order(p, ids)
                order.append(rows)
                kinds.append(kind)
                pers.append(restart * unit if restart else len(rows))
                wanted.append(-(-len(rows) // pers[-1]))
            if (found < wanted).any():
                raise ValueError("a scan has too few restart intervals")
            wanted, pers, sizes = np.array(wanted), np.array(pers), np.array([len(x) for x in order])
            nth_of = np.arange(wanted.sum()) - np.repeat(np.cumsum(wanted) - wanted, wanted)
            start = starts[np.repeat(np.cumsum(found) - found, wanted) + nth_of] * 8
            done = nth_of * np.repeat(pers, wanted)
            first = np.repeat(np.cumsum(sizes) - sizes, wanted) + done
            count = np.minimum(np.repeat(pers, wanted), np.repeat(sizes, wanted) - done)
            lanes = Lanes(Bits(data), start, first, count, np.concatenate(order), np.concatenate(kinds))
            for i in range(0, len(lanes.start), LANES):
                x = lanes.part(i)
                if lo == 0:
                    read_dc_refine(x, coef, al) if ah else read_dc_first(x, coef, tables, al)
                else:
                    (read_ac_refine if ah else read_ac_first)(x, coef, tables[0], lo, hi, al)
    return coef


def scan_order(p: Picture, ids: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, int]:
    """Rows of the coefficients in a scan's order, the place of each one's component in the scan, and blocks to a unit."""
    comps = [p.comps[k] for k in ids]
    at = comps[0].first
    rows, kinds, unit = order_of(tuple((c.first - at, c.h, c.v, c.across, c.down, c.own_across, c.own_down) for c in comps))
    return rows + at, kinds, unit


@lru_cache(2048)
def order_of(shape: tuple[tuple[int, ...], ...]) -> tuple[np.ndarray, np.ndarray, int]:
    if len(shape) == 1:
        first, _, _, across, _, own_across, own_down = shape[0]
        rows = (first + np.arange(own_down)[:, None] * across + np.arange(own_across)).ravel()
        return rows, np.zeros(len(rows), np.int64), 1
    parts, kinds = [], []
    for i, (first, h, v, across, down, _, _) in enumerate(shape):
        high, wide = down // v, across // h
        at = first + (np.arange(high) * v)[:, None, None, None] * across + (np.arange(wide) * h)[:, None, None] + np.arange(v)[:, None] * across + np.arange(h)
        parts.append(at.reshape(high * wide, -1))
        kinds += [i] * (h * v)
    rows = np.concatenate(parts, axis=1)
    return rows.ravel(), np.tile(kinds, len(rows)), rows.shape[1]


@cache
def inverse() -> np.ndarray:
    """64 x 64: coefficients in zigzag order to samples by rows, as integers scaled by 2^20."""
    u, x = np.arange(8)[:, None], np.arange(8)
    c = np.cos((2 * x + 1) * u * np.pi / 16) * np.where(u == 0, np.sqrt(1 / 8), 0.5)
    return np.round(np.kron(c, c)[zigzag()] * 2**20)


def samples(coef: np.ndarray, quant: np.ndarray) -> np.ndarray:
    """Blocks of 8 x 8 samples. Sums of integers below 2^53 are exact, whatever their order."""
    out = np.empty((len(coef), 64), np.uint8)
    for i in range(0, len(coef), LANES):
        s = (coef[i : i + LANES] * quant).astype(np.float64) @ inverse()
        out[i : i + LANES] = np.clip(np.floor((s + 2**19) / 2**20) + 128, 0, 255)
    return out


def rgb(p: Picture, blocks: dict[int, np.ndarray]) -> np.ndarray:
    """Planes from blocks, chroma repeated to full size, and colours in 16-bit fixed point."""
    hm, vm = max(c.h for c in p.comps.values()), max(c.v for c in p.comps.values())
    planes = []
    for k, c in p.comps.items():
        plane = blocks[k].reshape(c.down, c.across, 8, 8).swapaxes(1, 2).reshape(c.down * 8, c.across * 8)
        planes.append(plane.repeat(vm // c.v, axis=0).repeat(hm // c.h, axis=1)[: p.height, : p.width])
    if len(planes) == 1:
        return np.repeat(planes[0][:, :, None], 3, axis=2)
    y, cb, cr = planes[0].astype(np.int32), planes[1].astype(np.int32) - 128, planes[2].astype(np.int32) - 128
    half = 1 << 15
    r, g, b = y + (91881 * cr + half >> 16), y - (22554 * cb + 46802 * cr + half >> 16), y + (116130 * cb + half >> 16)
    return np.clip(np.stack((r, g, b), axis=2), 0, 255).astype(np.uint8)


def decode(files: list[bytes]) -> list[tuple[bytes, np.ndarray]]:
    """Of each file: the payload kept in its coefficients (empty if it isn't one of ours), and its RGB tensor."""
    pics = [parse(f) for f in files]
    coef = coefficients(pics)
    same = len({(tuple(p.quant[c.table].tolist())) for p in pics for c in p.comps.values()}) == 1
    whole = samples(coef, next(iter(pics[0].quant.values()))) if same and pics else None
    out = []
    for p in pics:
        blocks, rows = {}, []
        for k, c in p.comps.items():
            s = slice(c.first, c.first + c.across * c.down)
            blocks[k] = whole[s] if whole is not None else samples(coef[s], p.quant[c.table])
            rows.append(s)
        payload = b""
        if len(p.comment) == 8:
            (n,) = struct.unpack(">Q", p.comment)
            payload = coef[rows[0].start : rows[0].start + n // 64].astype(np.int8).tobytes()
        out.append((payload, rgb(p, blocks)))
    return out


def padded(text: bytes) -> bytes:
    return text + bytes(-len(text) % 64 or (64 if not text else 0))


def to_media(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_bytes and media, the stored form, in place of the text."""
    added = [T.StructField("n_bytes", T.LongType()), T.StructField("media", T.BinaryType())]
    kept = [f for f in docs.schema.fields if f.name not in (text, "n_bytes", "media")]
    schema = T.StructType([*kept, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, BATCH, 1024):
            texts = as_bytes(batch.column(text))
            made = [pa.array([len(t) for t in texts], pa.int64()), pa.array(encode([padded(t) for t in texts]), pa.binary())]
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], *made], names=schema.names)

    return docs.mapInArrow(run, schema)


def from_media(stored: DataFrame, tensors: bool = True) -> DataFrame:
    """stored (media) with payload digests, height, width, feature and, if asked for, rgb (bytes by rows, three a pixel)."""
    names = {"payload_bytes": T.LongType(), "payload_sha256": T.StringType(), "tail_crc32": T.LongType(), "media_bytes": T.LongType(), "media_sha256": T.StringType(), "height": T.LongType(), "width": T.LongType(), "feature": T.StringType()}
    names |= {"rgb": T.BinaryType()} if tensors else {}
    kept = [f for f in stored.schema.fields if f.name not in names]
    schema = T.StructType([*kept, *[T.StructField(n, t) for n, t in names.items()]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "media", BATCH, 1024):
            found = []
            files = batch.column("media").to_pylist()
            for f, (payload, pixels) in zip(files, decode(files), strict=True):
                raw = pixels.tobytes()
                mean = ",".join(f"{v / (pixels.shape[0] * pixels.shape[1]):.3f}" for v in pixels.reshape(-1, 3).sum(axis=0, dtype=np.int64).tolist())
                feature = f"{pixels.shape[0]}x{pixels.shape[1]};{mean};{zlib.crc32(raw):08x}"
                found.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(f), hashlib.sha256(f).hexdigest(), *pixels.shape[:2], feature, *[raw] * tensors))
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], *map(pa.array, zip(*found, strict=True))], names=schema.names)

    return stored.mapInArrow(run, schema)


def op2_progressive_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = from_media(to_media(documents(spark, sf_dir).select("doc_id", "text")), tensors=False)
    return read.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
