"""Basket, history, text and sampling operators."""
