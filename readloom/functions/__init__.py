"""readloom.functions"""
