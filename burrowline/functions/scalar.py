"""Column functions: names, dates, numbers. Bad input gives null, never an error (ANSI mode is on by default)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LONDON = "Europe/London"
#: Date-times in file names, tried in this order, and the format of what each finds.
NAME_DATES = (
    (r"([0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}-[0-9]{2}-[0-9]{2})[_ ]", "yyyy-MM-dd HH-mm-ss"),
    (r"([0-9]{4}-[0-9]{2}-[0-9]{2}_[0-9]{2}-[0-9]{2}-[0-9]{2})_", "yyyy-MM-dd_HH-mm-ss"),
    (r"([0-9]{4}-[0-9]{2}-[0-9]{2})[_ ]", "yyyy-MM-dd"),
)
SUPPORTED, CONVERTIBLE = (".avi", ".mp4", ".wmv", ".mov", ".flx", ".mkv"), (".ts", ".ffii")


def first_time(text: Column, formats: tuple[str, ...]) -> Column:
    """The first format that reads the text (X2-X4); null if none does. Formats are of numbers and what stands between them, so
    one with another number of colons can't read the text and isn't tried: a failure costs many times a success."""
    colons = F.length(text) - F.length(F.replace(text, F.lit(":"), F.lit("")))
    return F.coalesce(*[F.when(colons == f.count(":"), F.try_to_timestamp(text, F.lit(f))) for f in formats])


def name_time(name: Column) -> Column:
    """Date-time in a file name: with a space, with an underscore, date alone."""
    return F.coalesce(*[F.try_to_timestamp(F.nullif(F.regexp_extract(name, p, 1), F.lit("")), F.lit(f)) for p, f in NAME_DATES])


def localised(ts: Column, zone: str = LONDON) -> Column:
    """A naive local time as an instant."""
    return F.to_utc_timestamp(ts, zone)


def day_and_clock(day: Column, clock: Column) -> Column:
    """dd/MM/yyyy and HH:mm, seconds optional."""
    return first_time(F.concat_ws(" ", F.trim(day), F.trim(clock)), ("d/M/yyyy H:mm:ss", "d/M/yyyy H:mm", "d-M-yyyy H:mm:ss", "d-M-yyyy H:mm"))


def seconds_between(later: Column, earlier: Column) -> Column:
    """Difference in seconds, exact to the microsecond."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6)


def test_delay(kind: Column, offset_s: Column, default_s: float = 1200.0) -> Column:
    """Delay of the test after the sample: a short-term test without an offset gets the protocol's."""
    return F.when((kind == "STM") & (offset_s == 0), F.lit(default_s)).otherwise(offset_s)


def whole(c: Column, kind: str = "int") -> Column:
    """int(float(x))."""
    return c.try_cast("double").try_cast(kind)


def number(c: Column) -> Column:
    """float(x), NaN as null."""
    return known(c.try_cast("double"))


def known(c: Column) -> Column:
    """NaN as null."""
    return F.when(~F.isnan(c), c)


def file_name(path: Column) -> Column:
    """Last part of a path."""
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(file_name(path), r".(\.[^.]+)$", 1))


def media_class(path: Column) -> Column:
    """supported, convertible or unsupported, by suffix."""
    s = suffix(path)
    return F.when(s.isin(*SUPPORTED), "supported").when(s.isin(*CONVERTIBLE), "convertible").otherwise("unsupported")


def natural_key(name: Column) -> Column:
    """Sort key under which digits compare as numbers (O2)."""
    bare = lambda p: F.ltrim(p, F.lit("0"))
    # a number is its own length and then its digits, so runs of any length compare as numbers
    number_ = lambda p: F.when(bare(p) == "", "0000000010").otherwise(F.concat(F.lpad(F.length(bare(p)).cast("string"), 9, "0"), bare(p)))
    part = lambda p: F.when(F.substring(p, 1, 1).between("0", "9"), number_(p)).otherwise(p)
    return F.array_join(F.transform(F.regexp_extract_all(name, F.lit(r"([0-9]+|[^0-9]+)"), F.lit(1)), part), "")


def task_list(c: Column) -> Column:
    """Comma list to trimmed names (R6, X7); null stays null."""
    return F.transform(F.split(c, ","), lambda x: F.trim(x))


def plain_session(c: Column) -> Column:
    """Session name without parentheses and trailing space (SC2)."""
    return F.rtrim(F.translate(F.rtrim(c), "()", ""))


def microvolts_to_volts(gain: Column) -> Column:
    """X11."""
    return gain * F.lit(1e-6)


def split_offset(offset: Column) -> tuple[Column, Column]:
    """Seconds to add to the video's and to the recording's clock: whichever is behind."""
    return F.greatest(offset, F.lit(0.0)), F.greatest(-offset, F.lit(0.0))


def intensity(percent: Column) -> Column:
    """Percent as 0..1; what isn't positive is 0."""
    return F.when(percent > 0, percent / 100).otherwise(F.lit(0.0))


def catalogue_name(name: Column) -> Column:
    """File name under which the catalogue holds a session's copy."""
    return F.regexp_replace(name, r"\.nwb$", "_.nwb")


def sex_code(c: Column) -> Column:
    """Lookup with default."""
    table = F.create_map(F.lit("male"), F.lit("M"), F.lit("female"), F.lit("F"))
    return F.coalesce(F.try_element_at(table, F.lower(F.trim(c))), F.lit("U"))


def genotype(c: Column) -> Column:
    """Fixed values of the cohort's sheets (F9): null where the reference would stop; callers turn that into a reject reason."""
    return F.when(c == "wt", "WT").when(c == "het", "Syngap1+/Delta-GAP")


def clean_label(c: Column) -> Column:
    """Group and axis labels for display."""
    return F.trim(F.replace(F.replace(c, F.lit("_LFP_electrode_group"), F.lit("")), F.lit("Accelerometer"), F.lit("")))


def session_kind(session: Column) -> Column:
    """The kinds of session, fixed values, in order of precedence."""
    return F.when(session.contains("LTM"), "LTM").when(session.contains("STM"), "STM").when(session.contains("Hab"), "Hab").when(session.contains("Test"), "Test").otherwise("other")


def known_prey_session(session: Column) -> Column:
    """F6."""
    return session.rlike("Hab|Test|Weeto")


def session_key(session: Column) -> Column:
    """Lookup key of a session: without its day part."""
    return F.regexp_replace(session, "_Day[0-9]+$", "")


def session_name(task: Column, session: Column, day: Column | None = None, date: Column | None = None) -> Column:
    """Composed session id."""
    parts = [F.concat(task, F.lit("_"), session)]
    if day is not None:
        parts.append(F.when(day.isNotNull(), F.concat(F.lit("Day"), day.cast("string"))))
    if date is not None:
        parts.append(F.date_format(date, "yyyyMMdd"))
    return F.concat_ws("_", *parts)


def subject_name(animal: Column, cohort: Column, sep: str = "-") -> Column:
    """F11."""
    return F.concat_ws(sep, cohort.cast("string"), animal.cast("string"))


def people(experimenter: Column, scorer: Column) -> Column:
    """the experimenter, and the scorer if there is one and it is another."""
    return F.array_distinct(F.array_compact(F.array(experimenter, scorer)))
