"""The candlestick patterns: id, name and condition of each.

A condition is a SQL predicate over the columns of ``candles.measured``.

``up`` / ``down`` in a condition is the trend the pattern ends. Most shapes come in two
mirrored forms; ``sign`` is +1 for the form whose first candle is bullish and -1 for the
other one. Thresholds multiply the measured side as doubles, so that ties fall alike
everywhere.
"""

from dataclasses import dataclass

# fixed values: the shares that decide between patterns; more stand in the conditions below
LONG_MOVE = 0.03
GAP_MOVE = 0.02
SMALL_BODY = 0.3
TINY_BODY = 0.1
SAME_PRICE = 0.001


def _all_of(*conditions: str) -> str:
    return " AND ".join(f"({condition})" for condition in conditions)


def _any_of(conditions) -> str:
    return " OR ".join(f"coalesce({condition}, false)" for condition in conditions)


def _at(name: str, k: int = 0) -> str:
    return name if k == 0 else f"{name}{k}"


def _gain(sign: int, k: int = 0) -> str:
    """Close minus open k rows ago, or open minus close for ``sign`` -1."""
    o, c = _at("o", k), _at("c", k)
    return f"({c} - {o})" if sign > 0 else f"({o} - {c})"


def _beyond(sign: int, a: str, b: str) -> str:
    return f"{a} > {b}" if sign > 0 else f"{a} < {b}"


def _colour(sign: int, k: int = 0) -> str:
    """Bullish candle k rows ago, bearish for ``sign`` -1."""
    return _beyond(sign, _at("c", k), _at("o", k))


def _trend(sign: int, k: int = 0) -> str:
    return _at("up" if sign > 0 else "down", k)


def _gap(sign: int, k: int = 0) -> str:
    return _at("rising" if sign > 0 else "falling", k)


def _ratio(num: str, den: str, bound: str, when_zero: str) -> str:
    """``num / den`` compared with ``bound``; x/0 is an infinity of x's sign."""
    return (f"CASE WHEN {den} = 0 THEN {num} {when_zero} 0"
            f" ELSE try_divide({num}, {den}) {bound} END")


def _ratio_at_least(num: str, den: str, bound: float) -> str:
    return _ratio(num, den, f">= {bound}D", ">")


def _ratio_at_most(num: str, den: str, bound: float) -> str:
    return _ratio(num, den, f"<= {bound}D", "<")


def _same(a: str, b: str, of: str, share: float = SAME_PRICE) -> str:
    return f"abs({a} - {b}) <= {of} * {share}D"


def _pin_bar(trend: int) -> str:
    """Small body on top of a long lower tail."""
    return _all_of(_trend(trend), "body <= range / 3", "bottom - l >= 2 * body")


def _engulfing(sign: int) -> str:
    return _all_of(
        _trend(sign), _colour(sign, 1), _colour(-sign),
        _beyond(-sign, "c", "o1"), _beyond(sign, "o", "c1"))


def _star(sign: int, second_body: float) -> str:
    near, far = ("bottom1", "top2") if sign > 0 else ("top1", "bottom2")
    retreat = "(c2 - c)" if sign > 0 else "(c - c2)"
    return _all_of(
        _trend(sign, 2),
        _colour(sign, 2), _ratio_at_least(_gain(sign, 2), "o2", LONG_MOVE),
        f"body1 < (h1 - l1) * {second_body}D", _beyond(sign, near, far),
        _colour(-sign), _ratio_at_least(retreat, _gain(sign, 2), 0.5))


def _long_upper_tail(trend: int) -> str:
    return _all_of(
        _trend(trend, 1), f"body < range * {SMALL_BODY}D",
        "h - top > 2 * body", "bottom - l < 0.1D * body")


def _harami(trend: int, body_share: float) -> str:
    return _all_of(
        _trend(trend, 2), "body1 >= usual_body * 1.5D", f"body < range * {body_share}D",
        "top <= top1", "bottom >= bottom1")


def _tweezers(trend: int) -> str:
    side = "h" if trend > 0 else "l"
    return _all_of(_trend(trend), _same(side, f"{side}1", of=side), "body <= body1 * 0.5D")


def _belt_hold_after_fall() -> str:
    return _all_of(
        _trend(-1), _same("o", "l", of="l"), _same("c", "h", of="h"),
        _ratio_at_least(_gain(1), "o", LONG_MOVE))


def _belt_hold_after_rise() -> str:
    return _all_of(
        _trend(1), _same("h", "o", of="o"), _same("l", "c", of="c"),
        _ratio_at_least(_gain(-1), "o", LONG_MOVE))


def _two_crows() -> str:
    return _all_of(
        _trend(1, 2), _colour(1, 2), _colour(-1, 1), _colour(-1),
        "h2 < o1", "h2 < o", "o > o1", "c < c1")


def _three_crows() -> str:
    days = range(3)
    return _all_of(
        *(_colour(-1, k) for k in days),
        # all three tails are measured against the newest close
        *(_same(_at("l", k), _at("c", k), of="c", share=0.1) for k in days),
        "o > c1", "o < o1", "o1 > c2", "o1 < o2")


def _three_soldiers() -> str:
    days = range(3)
    return _all_of(
        *(_colour(1, k) for k in days),
        *(_ratio_at_least(_gain(1, k), _at("o", k), LONG_MOVE) for k in days),
        *(_same(_at("h", k), _at("c", k), of=_at("c", k), share=0.1) for k in days),
        "o < c1 * 1.02D", "o > o1 * 0.98D", "o1 < c2 * 1.02D", "o1 > o2 * 0.98D")


def _counterattack(sign: int) -> str:
    gapped = (_ratio_at_least("(o - c1)", "c1", GAP_MOVE) if sign > 0
              else _ratio_at_most("(o - c1)", "c1", -GAP_MOVE))
    return _all_of(
        _trend(sign, 1), _ratio_at_least(_gain(sign, 1), "o1", LONG_MOVE),
        _colour(-sign), gapped, "abs(c - c1) <= body1 * 0.1D")


def _tasuki(sign: int) -> str:
    return _all_of(
        _gap(sign, 1), _colour(sign, 1), _colour(-sign),
        "body >= 0.9D * body1", "body <= 1.1D * body1",
        _beyond(sign, "c", "h2" if sign > 0 else "l2"))


def _gapping_play(sign: int) -> str:
    """Gap after 4 to 7 small candles that stay within half a long body of its open."""

    def after(smalls: int) -> str:
        long = smalls + 1
        half, rows = f"{_at('body', long)} / 2", range(1, smalls + 1)
        bodies = ", ".join(_at("body", i) for i in rows)
        return _all_of(
            _colour(sign, long), f"{_at('body', long)} >= 3 * greatest({bodies})",
            *(f"NOT coalesce(top{i} > o{long} + {half} OR bottom{i} < o{long} - {half}, false)"
              for i in rows))

    return _all_of(_gap(sign), _any_of(after(smalls) for smalls in range(4, 8)))


def _side_by_side(sign: int) -> str:
    first, second = _gain(sign, 1), _gain(sign)
    return _all_of(
        _gap(sign, 2), _colour(sign, 1), _colour(sign), "o >= 0.9D * o1", "o <= 1.1D * o1",
        f"{second} >= 0.5D * {first}", f"{second} <= 2 * {first}")


def _three_methods(sign: int) -> str:
    """Two long candles of one colour around 2 to 4 small ones."""

    def around(smalls: int) -> str:
        first = smalls + 1
        bodies = ", ".join(_at("body", i) for i in range(1, smalls + 1))
        small = f"3 * greatest({bodies})"
        return _all_of(
            _colour(sign, first), _colour(sign),
            f"{_gain(sign, first)} >= {small}", f"{_gain(sign)} >= {small}",
            _beyond(sign, "c", _at("c", first)), _beyond(sign, "o", _at("o", first)))

    return _any_of(around(smalls) for smalls in range(2, 5))


def _separating_lines(sign: int) -> str:
    return _all_of(
        _trend(sign), _colour(-sign, 1), _colour(sign), "o >= 0.9D * o1", "o <= 1.1D * o1")


def _rare_doji(trend: int, *where: str) -> str:
    return _all_of(_trend(trend), "doji", "dojis < 5", *where)


def _three_stars(sign: int, extreme: str) -> str:
    """Three dojis in a row, one of them beyond the 20-row extreme of its day."""
    side = "h" if sign > 0 else "l"
    breaks = [_beyond(sign, side, extreme)]
    breaks += [_beyond(sign, _at(side, k), f"{extreme}_{k}") for k in (1, 2)]
    return _all_of("doji", "doji1", "doji2", "dojis < 6", _any_of(breaks))


@dataclass(frozen=True)
class Pattern:
    pattern_id: int
    name: str
    condition: str


# fixed values: the id of each pattern; 5, 6, 24, 25 and 28 to 31 are unassigned
_ALL = (
    Pattern(1, "hammer", _pin_bar(-1)),
    Pattern(2, "hanging_man", _pin_bar(1)),
    Pattern(3, "bullish_engulfing", _engulfing(-1)),
    Pattern(4, "bearish_engulfing", _engulfing(1)),
    Pattern(7, "morning_star", _star(-1, SMALL_BODY)),
    Pattern(8, "evening_star", _star(1, SMALL_BODY)),
    Pattern(9, "morning_doji_star", _star(-1, TINY_BODY)),
    Pattern(10, "evening_doji_star", _star(1, TINY_BODY)),
    Pattern(11, "shooting_star", _long_upper_tail(1)),
    Pattern(12, "inverted_hammer", _long_upper_tail(-1)),
    Pattern(13, "harami_after_uptrend", _harami(1, SMALL_BODY)),
    Pattern(14, "harami_after_downtrend", _harami(-1, SMALL_BODY)),
    Pattern(15, "harami_cross_after_uptrend", _harami(1, TINY_BODY)),
    Pattern(16, "harami_cross_after_downtrend", _harami(-1, TINY_BODY)),
    Pattern(17, "tweezers_bottom", _tweezers(-1)),
    Pattern(18, "tweezers_top", _tweezers(1)),
    Pattern(19, "belt_hold_after_downtrend", _belt_hold_after_fall()),
    Pattern(20, "belt_hold_after_uptrend", _belt_hold_after_rise()),
    Pattern(21, "upside_gap_two_crows", _two_crows()),
    Pattern(22, "three_black_crows", _three_crows()),
    Pattern(23, "three_white_soldiers", _three_soldiers()),
    Pattern(26, "counterattack_after_downtrend", _counterattack(-1)),
    Pattern(27, "counterattack_after_uptrend", _counterattack(1)),
    Pattern(32, "rising_window", _gap(1)),
    Pattern(33, "falling_window", _gap(-1)),
    Pattern(34, "rising_gap_tasuki", _tasuki(1)),
    Pattern(35, "falling_gap_tasuki", _tasuki(-1)),
    Pattern(36, "high_gapping_play", _gapping_play(1)),
    Pattern(37, "low_gapping_play", _gapping_play(-1)),
    Pattern(38, "rising_side_by_side", _side_by_side(1)),
    Pattern(39, "falling_side_by_side", _side_by_side(-1)),
    Pattern(40, "rising_three_methods", _three_methods(1)),
    Pattern(41, "falling_three_methods", _three_methods(-1)),
    Pattern(42, "rising_separating_lines", _separating_lines(1)),
    Pattern(43, "falling_separating_lines", _separating_lines(-1)),
    Pattern(44, "northern_doji", _rare_doji(1)),
    Pattern(45, "long_legged_doji", _rare_doji(
        -1, "(o + c) / 2 >= l + range / 3", "(o + c) / 2 <= h - range / 3")),
    Pattern(46, "gravestone_doji", _rare_doji(-1, "(o + c) / 2 <= l + range / 4")),
    Pattern(47, "dragonfly_doji", _rare_doji(1, "(o + c) / 2 >= h - range / 4")),
    # Their 20-row extreme includes the day compared with it, so these two never occur;
    # STRICT_PRIOR holds the form that leaves the day out.
    Pattern(48, "falling_three_stars", _three_stars(-1, "low20")),
    Pattern(49, "rising_three_stars", _three_stars(1, "high20")),
)

PATTERNS = {pattern.pattern_id: pattern for pattern in _ALL}

STRICT_PRIOR = {
    48: Pattern(48, "falling_three_stars", _three_stars(-1, "prior_low20")),
    49: Pattern(49, "rising_three_stars", _three_stars(1, "prior_high20")),
}
