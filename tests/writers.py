"""Small GeoTIFF and GeoPackage files for the tests."""

import sqlite3
import struct
import zlib

import numpy as np

from tessella.functions.geometry import to_wkb


def lzw_encode(data: bytes) -> bytes:
    out, held, bits, width = bytearray(), 0, 0, 9

    def put(code):
        nonlocal held, bits
        held, bits = held << width | code, bits + width
        while bits >= 8:
            bits -= 8
            out.append(held >> bits & 255)
        held &= (1 << bits) - 1

    table, n = {bytes([k]): k for k in range(256)}, 258
    put(256)
    word = b""
    for b in data:
        longer = word + bytes([b])
        if longer in table:
            word = longer
            continue
        put(table[word])
        table[longer] = n
        n += 1
        if n == 4094:
            put(256)
            table, n, width = {bytes([k]): k for k in range(256)}, 258, 9
        else:
            width = 12 if n >= 2048 else 11 if n >= 1024 else 10 if n >= 512 else 9
        word = bytes([b])
    if word:
        put(table[word])
        n += 1
        width = 12 if n >= 2048 else 11 if n >= 1024 else 10 if n >= 512 else 9
    put(257)
    if bits:
        out.append(held << (8 - bits) & 255)
    return bytes(out)


def geotiff(path, bands, x0=0.0, dx=1.0, y0=0.0, dy=-1.0, nodata=None, epsg=None, tile=None, rows=None, compress=1, predictor=1, order="<", planar=False, big=False):
    """bands: arrays of one shape and type, or one array."""
    bands = [bands] if isinstance(bands, np.ndarray) else bands
    height, width = bands[0].shape
    kind = bands[0].dtype.newbyteorder(order)
    bw, bh = tile or (width, rows or height)
    blocks = []
    for group in [[b] for b in bands] if planar else [bands]:
        cube = np.stack(group, 2)
        for top in range(0, height, bh):
            for left in range(0, width, bw):
                part = cube[top : top + bh, left : left + bw]
                if tile:
                    full = np.zeros((bh, bw, len(group)), cube.dtype)
                    full[: part.shape[0], : part.shape[1]] = part
                    part = full
                if predictor == 2:
                    part = np.concatenate([part[:, :1], np.diff(part, axis=1)], 1).astype(cube.dtype)
                if predictor == 3:
                    raw = np.ascontiguousarray(part.astype(cube.dtype.newbyteorder(">"))).view(np.uint8).reshape(part.shape[0], -1, cube.dtype.itemsize).transpose(0, 2, 1)
                    raw = raw.reshape(part.shape[0], -1, len(group))
                    data = np.concatenate([raw[:, :1], np.diff(raw, axis=1)], 1).astype(np.uint8).tobytes()
                else:
                    data = np.ascontiguousarray(part.astype(kind)).tobytes()
                blocks.append({1: lambda d: d, 5: lzw_encode, 8: zlib.compress}[compress](data))
    form = {"u": 1, "i": 2, "f": 3}[bands[0].dtype.kind]
    n = len(bands)
    wide = 16 if big else 4
    tags = {
        256: (4, [width]), 257: (4, [height]), 258: (3, [bands[0].dtype.itemsize * 8] * n), 259: (3, [compress]), 277: (3, [n]), 284: (3, [2 if planar else 1]), 317: (3, [predictor]), 339: (3, [form] * n),
        33550: (12, [dx, -dy, 0.0]), 33922: (12, [0.0, 0.0, 0.0, x0, y0, 0.0]),
    }
    tags |= {322: (4, [bw]), 323: (4, [bh])} if tile else {278: (4, [bh])}
    if nodata is not None:
        tags[42113] = (2, (str(nodata) + "\0").encode())
    if epsg:
        tags[34735] = (3, [1, 1, 0, 1, 2048 if epsg == 4326 else 3072, 0, 1, epsg])
    head = 16 if big else 8
    at, offsets = head, []
    for b in blocks:
        offsets.append(at)
        at += len(b) + len(b) % 2
    where, counts = (324, 325) if tile else (273, 279)
    tags |= {where: (wide, offsets), counts: (wide, [len(b) for b in blocks])}
    code = {2: "s", 3: "H", 4: "I", 12: "d", 16: "Q"}
    entry, inline, c = (20, 8, "Q") if big else (12, 4, "I")
    base = at + (8 if big else 2) + entry * len(tags) + inline
    table, extra = b"", b""
    for tag, (t, v) in sorted(tags.items()):
        data = v if t == 2 else struct.pack(f"{order}{len(v)}{code[t]}", *v)
        table += struct.pack(f"{order}HH{c}", tag, t, len(v))
        if len(data) <= inline:
            table += data.ljust(inline, b"\0")
        else:
            table += struct.pack(order + c, base + len(extra))
            extra += data + b"\0" * (len(data) % 2)
    with open(path, "wb") as f:
        f.write((b"II" if order == "<" else b"MM") + (struct.pack(f"{order}HHHQ", 43, 8, 0, at) if big else struct.pack(f"{order}HI", 42, at)))
        for b in blocks:
            f.write(b + b"\0" * (len(b) % 2))
        f.write(struct.pack(order + ("Q" if big else "H"), len(tags)) + table + struct.pack(order + c, 0) + extra)


def square(x0, y0, x1, y1):
    return [[(x0, y0), (x1, y0), (x1, y1), (x0, y1)]]


def gpkg(path, layers):
    """layers: name -> (srs id, [(attribute, SQL type)], [(fid, polygons or None, values...)])."""
    db = sqlite3.connect(path)
    db.execute("CREATE TABLE gpkg_contents (table_name TEXT, data_type TEXT, identifier TEXT, srs_id INTEGER)")
    db.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT, geometry_type_name TEXT, srs_id INTEGER, z INT, m INT)")
    db.execute("CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT, srs_id INTEGER, organization TEXT, organization_coordsys_id INTEGER, definition TEXT)")
    for code in (-1, 0, 4326, 3857, 32633):
        db.execute("INSERT INTO gpkg_spatial_ref_sys VALUES (?, ?, ?, ?, ?)", [str(code), code, "NONE" if code < 1 else "EPSG", code, "undefined"])
    for name, (srs, attributes, rows) in layers.items():
        db.execute("INSERT INTO gpkg_contents VALUES (?, 'features', ?, ?)", [name, name, srs])
        db.execute("INSERT INTO gpkg_geometry_columns VALUES (?, 'geom', 'GEOMETRY', ?, 0, 0)", [name, srs])
        db.execute(f'CREATE TABLE "{name}" (fid INTEGER PRIMARY KEY, geom BLOB, ' + ", ".join(f'"{a}" {t}' for a, t in attributes) + ")")
        for fid, polygons, *values in rows:
            blob = None if polygons is None else b"GP\0" + bytes([1]) + struct.pack("<i", srs) + to_wkb(polygons)
            db.execute(f'INSERT INTO "{name}" VALUES (?, ?{", ?" * len(values)})', [fid, blob, *values])
    db.commit()
    db.close()
