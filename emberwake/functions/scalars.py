"""Column expressions for event tables.

Every function returns a ``Column`` built from Spark's built-in functions, so
it runs inside whole-stage codegen on the executors; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for the same results)
# ---------------------------------------------------------------------------

# Spoken greetings, in the reference's order.
GREETINGS = ["Hello.", "Welcome.", "May I help you?"]

# Class labels for "at least one detection" / "none".
CLASS_LABELS = ("facial", "nonfacial")

# Item key: "<prefix>-<class>-<yyyyMMddHHmmss>"
ITEM_PREFIX = "webcam"
SECOND_KEY_FORMAT = "yyyyMMddHHmmss"

# Retention quotas per class.
DEFAULT_QUOTA = 20

# Event-type mask covering all 24 type bits.
FULL_MASK = 0xFFFFFF
# Event-type codes (public Cocoa NSEventType values) used by the masks.
LEFT_MOUSE_DOWN = 1
RIGHT_MOUSE_DOWN = 3
MOUSE_MOVED = 5
KEY_DOWN = 10
KEY_UP = 11
FLAGS_CHANGED = 12
SCROLL_WHEEL = 22

# Modifier flag bits (public Cocoa modifier masks), reported in this order:
# Ctrl, Alt, Cmd, Shift (Shift also covers Caps Lock).
CONTROL_BIT = 1 << 18
ALTERNATE_BIT = 1 << 19
COMMAND_BIT = 1 << 20
SHIFT_BIT = 1 << 17
ALPHA_SHIFT_BIT = 1 << 16

# Key codes with their own names, and the label formats printed per key event.
ENTER_KEY_CODE = 36
BACKSPACE_KEY_CODE = 51
PRESSED_CHAR_FORMAT = "alphanumeric key %s pressed"
PRESSED_SPECIAL_FORMAT = "special key %s pressed"
RELEASED_FORMAT = "%s released"

# Character-code -> key name table: Tab (U+0009), Escape (U+001B), then the
# function-key area from U+F700 upward, one name per consecutive code.
KEY_NAMES_LOW = [(0x0009, "Tab"), (0x001B, "Escape")]
FUNCTION_AREA_START = 0xF700
FUNCTION_AREA_NAMES = [
    "Up", "Down", "Left", "Right",
    "F1", "F2", "F3", "F4", "F5", "F6", "F7", "F8", "F9", "F10",
    "F11", "F12", "F13", "F14", "F15", "F16", "F17", "F18", "F19", "F20",
    "F21", "F22", "F23", "F24", "F25", "F26", "F27", "F28", "F29", "F30",
    "F31", "F32", "F33", "F34", "F35",
    "Insert", "Delete", "Home", "Begin", "End", "PageUp", "PageDown",
    "PrintScreen", "ScrollLock", "Pause", "SysReq", "Break", "Reset", "Stop",
    "Menu", "User", "System", "Print", "ClearLine", "ClearDisplay",
    "InsertLine", "DeleteLine", "InsertChar", "DeleteChar", "Prev", "Next",
    "Select", "Execute", "Undo", "Redo", "Find", "Help", "ModeSwitch",
]

# Button numbers for pointer dispatch.
BUTTON_LEFT, BUTTON_RIGHT = 1, 3
SCROLL_UP, SCROLL_DOWN, SCROLL_RIGHT, SCROLL_LEFT = 4, 5, 6, 7


def key_code_rows() -> list[tuple[int, str]]:
    return KEY_NAMES_LOW + [(FUNCTION_AREA_START + i, n) for i, n in enumerate(FUNCTION_AREA_NAMES)]


def key_code_dimension(spark: SparkSession) -> DataFrame:
    """The 74-row code -> name dimension (J1's right side; fixed size)."""
    return spark.createDataFrame(key_code_rows(), "code int, name string")


# ---------------------------------------------------------------------------
# Geometry and classes
# ---------------------------------------------------------------------------

def norm(dx: Column, dy: Column) -> Column:
    """Euclidean length of a 2-D delta."""
    return F.sqrt(dx * dx + dy * dy)


def classify(n_detections: Column, labels: tuple[str, str] = CLASS_LABELS) -> Column:
    """Two-way class by detection count."""
    return F.when(n_detections > 0, F.lit(labels[0])).otherwise(F.lit(labels[1]))


def second_key(ts: Column) -> Column:
    """14-digit second key ``yyyyMMddHHmmss``."""
    return F.date_format(ts, SECOND_KEY_FORMAT)


def item_key(cls: Column, key: Column, prefix: str = ITEM_PREFIX) -> Column:
    """Item name from class and second key."""
    return F.concat_ws("-", F.lit(prefix), cls, key)


def draw_hash(seed: int, *ids: Column) -> Column:
    """A number below 2^60 drawn by ``seed`` and ``ids`` (R10, T3): equal under any
    partitioning and on a repeated attempt. A null id counts as its own value."""
    texts = [F.coalesce(F.concat(F.lit("="), i.cast("string")), F.lit("")) for i in ids]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *texts).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def pick(choices: list[str], index: Column | None = None, seed: int | None = None,
         key: Column | None = None) -> Column:
    """One element of a fixed list (R10): keyed by ``index`` (deterministic),
    drawn by ``seed`` and a row's ``key`` (the same whatever the partitioning), or
    drawn with ``rand(seed)``, which depends on partitions."""
    arr = F.array(*[F.lit(c) for c in choices])
    n = len(choices)
    if index is not None:
        pos = F.pmod(index.cast("long"), F.lit(n)) + 1
    elif key is not None:
        pos = F.pmod(draw_hash(seed or 0, key), F.lit(n)) + 1
    else:
        pos = F.floor(F.rand(seed) * n).cast("int") + 1
    return F.element_at(arr, pos.cast("int"))


# ---------------------------------------------------------------------------
# Bit masks
# ---------------------------------------------------------------------------

def type_bit(code: Column) -> Column:
    """The code's bit; codes outside 0..63 have none."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), code.cast("int"))
    return F.when(code.between(0, 63), bit).when(code.isNotNull(), F.lit(0).cast("long"))


def mask_without(mask: int, drop_types=()) -> int:
    """Remove types from a mask by XOR (R12); an unset bit gets *set*."""
    for t in drop_types:
        mask ^= (1 << int(t))
    return mask


def mask_match(code: Column, mask: int = FULL_MASK) -> Column:
    """Event-type mask predicate."""
    return (type_bit(code).bitwiseAND(F.lit(mask).cast("long"))) != 0


def mask_union(code: Column) -> Column:
    """OR of type bits as an aggregate."""
    return F.bit_or(type_bit(code))


# ---------------------------------------------------------------------------
# Key events
# ---------------------------------------------------------------------------

def key_label(char: Column, key_name: Column, released: Column | None = None) -> Column:
    """Printable vs special key label (R14); release events use the released form."""
    pressed = F.when(char.isNotNull(), F.format_string(PRESSED_CHAR_FORMAT, char)) \
        .otherwise(F.format_string(PRESSED_SPECIAL_FORMAT, key_name))
    if released is None:
        return pressed
    return F.when(released, F.format_string(RELEASED_FORMAT, F.coalesce(char, key_name))) \
        .otherwise(pressed)


def is_sentinel(c: Column, value) -> Column:
    """Sentinel predicate."""
    return F.coalesce(c == F.lit(value), F.lit(False))


def key_override(code: Column, char: Column) -> Column:
    """Enter / Backspace names for two key codes."""
    return (F.when(code == ENTER_KEY_CODE, F.lit("Enter"))
            .when(code == BACKSPACE_KEY_CODE, F.lit("Backspace"))
            .otherwise(char))


def dispatch(kind: Column, dx: Column, dy: Column) -> Column:
    """Button number for a pointer event.

    ``kind`` is one of 'left_down', 'right_down', 'scroll'. For a scroll the
    horizontal axis wins over the vertical one; a 0/0 scroll yields null.
    """
    return (F.when(kind == "left_down", F.lit(BUTTON_LEFT))
            .when(kind == "right_down", F.lit(BUTTON_RIGHT))
            .when((kind == "scroll") & (dx > 0), F.lit(SCROLL_RIGHT))
            .when((kind == "scroll") & (dx < 0), F.lit(SCROLL_LEFT))
            .when((kind == "scroll") & (dy > 0), F.lit(SCROLL_UP))
            .when((kind == "scroll") & (dy < 0), F.lit(SCROLL_DOWN)))


def modifiers(flags: Column) -> Column:
    """Modifier names from flag bits, order Ctrl, Alt, Cmd, Shift."""
    f = flags.cast("long")

    def has(bits: int) -> Column:
        return f.bitwiseAND(F.lit(bits)) != 0

    return F.array_compact(F.array(
        F.when(has(CONTROL_BIT), F.lit("Ctrl")),
        F.when(has(ALTERNATE_BIT), F.lit("Alt")),
        F.when(has(COMMAND_BIT), F.lit("Cmd")),
        F.when(has(SHIFT_BIT | ALPHA_SHIFT_BIT), F.lit("Shift")),
    ))
