"""The transverse Mercator forward projection as SQL text for oracle statements."""

from __future__ import annotations

from agrolume.functions import geo


def _along(kind: str) -> str:
    out = "xi" if kind == "north" else "eta"
    for j, value in enumerate(geo._ALPHA, start=1):
        trig = f"sin({2 * j}*xi)*cosh({2 * j}*eta)" if kind == "north" else f"cos({2 * j}*xi)*sinh({2 * j}*eta)"
        out += f" + {value!r}::double*{trig}"
    return f"({out})*{0.9996 * geo._RECTIFYING!r}::double"


def utm(relation: str) -> str:
    """A statement with columns east and north beside those of ``relation``, which has lon, lat and zone (northern)."""
    e = f"{geo.E!r}::double"
    return (
        f"select * exclude (dl, t, xi, eta), {_along('east')} + 500000 as east, {_along('north')} as north from "
        "(select *, atan2(t, cos(dl)) as xi, atanh(sin(dl)/sqrt(1 + t*t)) as eta from (select *, radians(lon) - radians(zone*6 - 183) as dl, "
        f"sinh(atanh(sin(radians(lat))) - {e}*atanh({e}*sin(radians(lat)))) as t from ({relation}) u1) u2) u3"
    )


def grid_corners() -> str:
    """grid_no, glon, glat: the north-west corner of each grid."""
    from agrolume.plans.world import GRID_CORNERS

    return f"select {GRID_CORNERS['grid_no']} as grid_no, {GRID_CORNERS['lon']} as glon, {GRID_CORNERS['lat']} as glat from supplier"
