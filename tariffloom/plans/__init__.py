"""Whole plans: conversion of documents to a fact table, named views, the nearby-price query, jobs."""
