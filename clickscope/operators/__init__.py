"""Lazy DataFrame operators of the batch jobs and the ad stream."""
