"""Analytic operators: functions from tables to a DataFrame.

They are lazy, except that rankings and model training store their input once in the shared scratch
folder. Writing results is left to ``sources.sinks``.
"""
