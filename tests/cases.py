"""Sessions with known intervals: S start, E end, B background, G foreground, H heartbeat, X error, p pause, r resume; seconds after 17:00."""

KINDS = {"S": "VideoSessionStart", "E": "VideoSessionEnd", "B": "AppBackgrounded", "G": "AppForegrounded", "H": "VideoHeartbeat", "X": "VideoError", "p": "VideoHeartbeat", "r": "VideoHeartbeat"}
SUB = {"p": "pause", "r": "resume"}
BASE = 1_700_000_000_000 // 3_600_000 * 3_600_000

_F02 = "S0 H60 H120 H180 H240 H300 H360 H420 H480"
CASES = {
    "F01": ("S60 H120 H180 B600 G605 H660 H840 H1320 H1380", [(60, 240), (605, 720), (840, 900), (1320, 1440)]),
    "F02": (_F02, [(0, 540)]),
    "F03": (f"{_F02} H660", [(0, 540), (660, 720)]),
    "F04": (f"{_F02} H660 E900", [(0, 540), (660, 720)]),
    "F05A": ("S60 H120 H180 E240", [(60, 240)]),
    "F05B": ("S150 E190", [(150, 190)]),
    "F06": ("S0 H60 E120", [(0, 120)]),
    "F07": ("S0 H60.001 E90", [(0, 60), (60.001, 90)]),
    "F08": ("S0 S10 B20 B25 G40 G45 E70 E80", [(0, 20), (40, 70)]),
    "F09": ("S5 B10 G20 B30 G40 E50", [(5, 10), (20, 30), (40, 50)]),
    "F10": ("S0 G30 B30 E50", [(0, 30)]),
    "F11": ("S0 E40 G50 B80", [(0, 40), (50, 80)]),
    "F12": ("S0 E40 G50", [(0, 40)]),
    "F13": ("H0 H40 E80", [(0, 80)]),
    "F14": ("B0 G40 E80", [(40, 80)]),
    "F15": ("S0 X40 E80", [(0, 80)]),
    "F16": ("S0 B30", [(0, 30)]),
    "F17": ("H0", [(0, 60)]),
    "F18": ("S0 B30 H60 H90 E120", [(0, 30)]),
    "F19": ("S0 B30 H180 E210", [(0, 30), (180, 210)]),
}


def events(text):
    """(kind, ms) of each event of a case."""
    return [(x[0], BASE + round(float(x[1:]) * 1000)) for x in text.split()]


def rows(cases):
    return [(1, name, "u", KINDS[k], SUB.get(k, "x"), ms, "web ", "v1", "in", None, None, None, None, ms) for name, (text, _) in cases.items() for k, ms in events(text)]
