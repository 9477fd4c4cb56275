"""Array functions: padding, packing tracks, patches, vectors, alignments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ids of the special tokens, and the padding mark.
AUDIO_START, AUDIO_END, PROMPT_START, PROMPT_END, TEXT_END, PAD, TTS = 101, 102, 103, 104, 2, -100, 1


def _repeat(x, n: Column) -> Column:
    return F.array_repeat(F.lit(x), n.cast("int"))


def _array(*xs) -> Column:
    return F.array(*[F.lit(x) if isinstance(x, int) else x for x in xs])


def unpad(arr: Column, pad: float = PAD) -> Column:
    at = F.array_position(arr, F.lit(pad).cast("double") if isinstance(pad, float) else F.lit(pad))
    return F.when(at > 0, F.slice(arr, F.lit(1), (at - 1).cast("int"))).otherwise(arr)


def pad_to(arr: Column, n: Column, pad) -> Column:
    """arr cut or filled to n items."""
    return F.slice(F.concat(arr, F.array_repeat(F.lit(pad), F.greatest(n - F.size(arr), F.lit(0)).cast("int"))), F.lit(1), n.cast("int"))


def pack_target(text_ids: Column, audio: Column, is_prompt: Column) -> Column:
    """Tracks of a sample without reference: text, start, audio positions, end; nothing is learned from a prompt."""
    n = F.size(text_ids)
    mask = F.concat(_repeat(0, n + 1), _repeat(1, audio), _array(0))
    total = n + audio + 2
    return F.struct(
        F.concat(text_ids, F.array(F.when(is_prompt, PROMPT_START).otherwise(AUDIO_START)), _repeat(0, audio), F.array(F.when(is_prompt, PROMPT_END).otherwise(AUDIO_END))).alias("tokens"),
        F.transform(mask, lambda x: 1 - x).alias("text_mask"),
        mask.alias("audio_mask"),
        F.when(is_prompt, _repeat(0, total)).otherwise(mask).alias("loss_mask"),
        F.concat(_repeat(0, total - 2), _array(1, 0)).alias("labels"),
    )


def pack_with_reference(ref: Column, text_ids: Column, audio: Column) -> Column:
    """Tracks with reference positions first; only the target's audio is learned."""
    n = F.size(text_ids)
    head = F.concat(_array(0), _repeat(1, ref), _repeat(0, n + 2))
    mask = F.concat(head, _repeat(1, audio), _array(0))
    return F.struct(
        F.concat(_array(PROMPT_START), _repeat(0, ref), _array(PROMPT_END), text_ids, _array(AUDIO_START), _repeat(0, audio), _array(AUDIO_END)).alias("tokens"),
        F.transform(mask, lambda x: 1 - x).alias("text_mask"),
        mask.alias("audio_mask"),
        F.concat(_repeat(0, ref + n + 3), _repeat(1, audio), _array(0)).alias("loss_mask"),
        F.concat(_repeat(0, ref + n + audio + 2), _array(1, 0)).alias("labels"),
    )


def position_ids(n: Column, most: Column) -> Column:
    return pad_to(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")), most, 0)


def id_track(audio_mask: Column, value: Column) -> Column:
    return F.transform(audio_mask, lambda x: x * value)


def generation_prefix(mode: Column, text_ids: Column, ref: Column, prompt: Column) -> Column:
    """Token layout at inference, by mode."""
    text = F.concat(text_ids, _array(AUDIO_START))
    front = F.concat(_array(PROMPT_START), _repeat(0, ref), _array(PROMPT_END))
    with_ref = F.when(mode.isin("reference", "ref_continuation"), F.concat(front, text)).otherwise(text)
    return F.when(mode.isin("continuation", "ref_continuation"), F.concat(with_ref, _repeat(0, prompt))).otherwise(with_ref)


def pad_to_multiple(arr: Column, n: int, side: str = "right", zero=0.0) -> Column:
    fill = F.array_repeat(F.lit(zero), F.pmod(-F.size(arr), F.lit(n)).cast("int"))
    return F.concat(fill, arr) if side == "left" else F.concat(arr, fill)


def patchify(arr: Column, p: int, zero=0.0) -> Column:
    full = pad_to_multiple(arr, p, "right", zero)
    n = F.floor(F.size(full) / p).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice(full, i * p + 1, F.lit(p))))


def quantize_vector(vec: Column, scale: int = 9) -> Column:
    return F.transform(vec, lambda x: F.rint(F.tanh(x.cast("double")) * scale) / scale)


def bucketize(v: Column, bounds=(20000, 30000, 40000)) -> Column:
    return sum(((v > b).cast("int") for b in bounds[1:]), (v > bounds[0]).cast("int"))


#: Packing by task, for tasks that users add: (text ids, audio length, is_prompt) -> tracks.
PACKERS = {"tts": pack_target}


def pack(task: str, text_ids: Column, audio: Column, is_prompt: Column) -> Column:
    if task not in PACKERS:
        raise ValueError(f"unknown task {task}: one of {sorted(PACKERS)}")
    return PACKERS[task](text_ids, audio, is_prompt)


def context_before(mask: Column, k: int) -> Column:
    """Positions (from 0) of the last k - 1 audio positions of a prefix, or of as many as there are: the context with which generation begins. None where the prefix doesn't end with audio."""
    at = F.when(F.try_element_at(mask, F.lit(-1)) == 1, F.array_compact(F.transform(mask, lambda x, i: F.when(x == 1, i)))).otherwise(F.array().cast("array<int>"))
    last = lambda x: F.slice(x, F.greatest(F.size(x) - k + 2, F.lit(1)), F.lit(k - 1))
    return F.get(F.transform(F.array(at), last), 0)  # bound, so that it is made once
