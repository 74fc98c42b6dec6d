"""Pedestrian-track preparation as Spark DataFrame jobs."""

from pathloom.config import SceneConfig

__all__ = ["SceneConfig"]
