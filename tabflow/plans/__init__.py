"""Data products built from the operators: conversion by segment, pickup
location statistics and reports, engagement segments, import flows."""
