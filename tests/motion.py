"""Scripted walks whose labels are known by construction."""

import numpy as np

FPS = 30.0


def skeleton(root, heading, lift=(0.0, 0.0), stride=(0.0, 0.0)):
    """24 joints about a root point, facing `heading` radians."""
    forward = np.array([np.cos(heading), np.sin(heading), 0.0])
    left = np.array([-np.sin(heading), np.cos(heading), 0.0])
    up = np.array([0.0, 0.0, 1.0])
    points = np.tile(root, (24, 1)).astype(float)

    def put(k, f=0.0, s=0.0, z=0.0):
        points[k] = root + f * forward + s * left + z * up

    for k, side in ((1, 0.1), (2, -0.1)):
        put(k, 0, side, -0.05)
    for side, j, lifted, step in ((0.1, 0, lift[0], stride[0]), (-0.1, 1, lift[1], stride[1])):
        put(4 + j, step / 2, side, -0.45)
        put(7 + j, step, side, -root[2] + 0.08 + lifted)
        put(10 + j, step + 0.1, side, -root[2] + 0.02 + lifted)
        put(16 + j, 0, side * 2, 0.5)
        put(20 + j, 0.05, side * 2.4, 0.0)
    for k, z in ((3, 0.1), (6, 0.2), (9, 0.3), (12, 0.5), (15, 0.65), (13, 0.45), (14, 0.45)):
        put(k, 0, 0, z)
    return points


def rows(trial, path, subset="A", subject="s1"):
    """path: list of (root xyz, heading radians); feet alternate 0.6 s down, 0.4 s up."""
    out = []
    for i, (root, heading) in enumerate(path):
        t = i / FPS
        lift, stride = [], []
        for shift in (0.0, 0.5):
            phase = (t + shift) % 1.0
            swing = phase >= 0.6
            lift.append(0.12 * np.sin(np.pi * (phase - 0.6) / 0.4) if swing else 0.0)
            stride.append(0.3 - phase if not swing else -0.3 + 0.6 * (phase - 0.6) / 0.4)
        joints = skeleton(np.array(root, float), heading, lift, stride)
        out.append((subset, subject, trial, i, [tuple(map(float, p)) for p in joints], tuple(map(float, root))))
    return out


SCHEMA = (
    "subset string, subject_id string, trial_id string, frame_index int, "
    "joints_can array<struct<x: double, y: double, z: double>>, trans_can struct<x: double, y: double, z: double>"
)


def walk(seconds=6.0, speed=1.0):
    return [((speed * i / FPS, 0.0, 0.9), 0.0) for i in range(int(seconds * FPS))]


def walk_turn_walk():
    path, x, y, heading = [], 0.0, 0.0, 0.0
    for i in range(int(8 * FPS)):
        t = i / FPS
        if 3 <= t < 5:
            heading = np.pi * (t - 3) / 2
        elif t >= 5:
            heading = np.pi
        speed = 0.3 if 3 <= t < 5 else 1.0
        x += speed * np.cos(heading) / FPS
        y += speed * np.sin(heading) / FPS
        path.append(((x, y, 0.9), heading))
    return path


def sit_stand():
    path = []
    for i in range(int(9 * FPS)):
        t = i / FPS
        z = 0.9 if t < 2 else 0.9 - 0.4 * (t - 2) if t < 3 else 0.5 if t < 5 else 0.5 + 0.4 * (t - 5) if t < 6 else 0.9
        x = 0.5 * t if t < 2 else 1.0 if t < 6 else 1.0 + 0.5 * (t - 6)
        path.append(((x, 0.0, z), 0.0))
    return path
