"""readloom.operators"""
